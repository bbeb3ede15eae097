"""Brute force, round trips and edge cases for the operators of the subpackage."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from evidara.llm import byte_bpe, cotraining, gated_lm, language_id, near_duplicates, packing, quality_rules, queries, repeats, textkit, threshold_search, url_filters

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, node string"
ODD = [None, "", "   \n\t ", "one", "One two", "a b c d e f g h " * 40, "x" * 5000, "é ü ß " * 30, "same text here " * 30, "same text here " * 30]


def frame(spark, texts):
    """Texts with clashing extra columns."""
    return spark.createDataFrame([(i, t, "en", None if i % 3 else "s", None, "k", "n") for i, t in enumerate(texts)], SCHEMA)


def words(text):
    return (text or "").encode().split()


def test_words_match_python(spark):
    import pyarrow as pa

    w = textkit.Words(*textkit.text_buffers(pa.array(ODD)))
    assert w.count.tolist() == [len(words(t)) for t in ODD]
    h = {}
    for text, x in zip([x.lower() for t in ODD for x in words(t)], w.hashes(lower=True).tolist(), strict=True):
        assert h.setdefault(text, x) == x
    assert len(set(h.values())) == len(h)


# -- op1 ---------------------------------------------------------------------------------------------------------


def test_base_scores_match_brute_force(spark):
    docs = frame(spark, ODD)
    got = {r.doc_id: r for r in gated_lm.lm_scores(docs).collect()}
    tokens = {i: [x.lower() for x in words(t)] + [None] for i, t in enumerate(ODD)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = collections.Counter(x for i, ts in tokens.items() if not held[i] for x in ts)
    n, v = sum(c.values()), len(c)
    for i, ts in tokens.items():
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (held[i], len(ts), sum(c[x] > 0 for x in ts), n)
        assert got[i].base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in ts))
        assert math.isfinite(got[i].score) and got[i].score < 0


def test_lm_of_empty_table(spark):
    assert gated_lm.lm_scores(frame(spark, ODD).where("false")).count() == 0


def test_model_beats_counts_on_held_out_text(spark):
    rows = queries.op1_gated_lm(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_scores_match_a_plain_loop(spark, monkeypatch):
    kept = {}
    train, vocabulary = gated_lm.train, gated_lm.build_vocabulary
    monkeypatch.setattr(gated_lm, "train", lambda *a: kept.setdefault("p", train(*a)))
    monkeypatch.setattr(gated_lm, "build_vocabulary", lambda *a: kept.setdefault("v", vocabulary(*a)))
    s = gated_lm.Settings(n_single=64, n_classes=8, n_suffix=5, hidden=6)
    docs = queries.table(spark, SF, "documents").where("n_chars < 3000")
    got = {r.doc_id: r.score for r in gated_lm.lm_scores(docs, settings=s).collect()}
    v, p = kept["v"][0], {k: x.astype(np.float64) for k, x in kept["p"].items()}
    rows = docs.select("doc_id", "text").collect()
    counts = collections.Counter(x.lower() for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for x in words(r.text))
    for r in rows[:12]:
        h, last, total = np.zeros((1, 6)), v.end, 0.0
        data, at = textkit.text_buffers(__import__("pyarrow").array([r.text]))
        tokens, *_ = gated_lm.token_stream(data, at, v)
        for word, y in zip([*(x.lower() for x in words(r.text)), None], tokens.tolist(), strict=True):
            h = gated_lm.step(p, h, np.array([last]))[0]
            of_class = h[0] @ p["Wc"] + p["bc"]
            of_class -= np.log(np.exp(of_class).sum())
            if y < s.n_single:
                c, place = divmod(y, s.per_class)
                inside = h[0] @ p["Ww"][c] + p["bw"][c]
                total += of_class[c] + inside[place] - np.log(np.exp(inside).sum())
            else:
                total += of_class[s.n_classes + y - s.n_single] + math.log((counts[word] + 1) / v.rest[y - s.n_single])
            last = y
        assert got[r.doc_id] == pytest.approx(total / math.log(10), rel=1e-3)


def small_model():
    s = gated_lm.Settings(n_single=8, n_classes=2, n_suffix=3, hidden=4, window=5)
    v = gated_lm.Vocabulary(np.array([gated_lm.END]), np.array([3]), np.array([0]), np.array([-1]), np.ones(3), 9, 3, s)
    v.start_class, v.start_word = np.zeros(5, np.float32), np.zeros((2, 4), np.float32)
    return s, {k: x.astype(np.float64) for k, x in gated_lm.fresh_weights(v).items()}


def test_gradients_match_differences():
    s, p = small_model()
    draw = np.random.default_rng(0)
    x, y = draw.integers(0, 11, (5, 3)), draw.integers(0, 11, (5, 3))
    fresh, live = np.zeros((5, 3), bool), np.ones((5, 3), bool)
    fresh[0], fresh[2, 1], live[4, 2] = True, True, False

    def loss(p):
        h, out = np.zeros((3, 4)), 0.0
        for t in range(5):
            h = gated_lm.step(p, h * ~fresh[t][:, None], x[t])[0]
            out -= (gated_lm.log_likelihood(p, h, y[t], s) * live[t]).sum()
        return out

    g, _ = gated_lm.gradients(p, np.zeros((3, 4)), x, y, fresh, live, s)
    ratios = []
    for k in p:
        for _ in range(4):
            at = tuple(draw.integers(0, n) for n in p[k].shape)
            up, down = ({n: a.copy() for n, a in p.items()} for _ in range(2))
            up[k][at] += 1e-4
            down[k][at] -= 1e-4
            true = (loss(up) - loss(down)) / 2e-4
            if abs(true) > 1e-3:
                ratios.append(g[k][at] / true)  # all have one scale: tokens, and the clip of the norm
    assert len(ratios) > 5 and np.ptp(ratios) < 1e-2 * abs(np.mean(ratios))


def test_state_is_carried_and_order_does_not_matter():
    s, p = small_model()
    draw = np.random.default_rng(1)
    texts = [draw.integers(0, 11, n) for n in (1, 70, 3, 1, 25_000, 9)]
    alone = [gated_lm.score_texts(p, t, np.array([0]), 0, s) for t in texts]
    begin = np.cumsum([0, *(len(t) for t in texts[:-1])])
    together = gated_lm.score_texts(p, np.concatenate(texts), begin, 0, s)
    assert np.allclose(np.concatenate(alone), together, atol=1e-4)
    h, last, out = np.zeros((1, 4)), 0, []
    for t in texts[1].tolist():
        h = gated_lm.step(p, h, np.array([last]))[0]
        out.append(gated_lm.log_likelihood(p, h, np.array([t]), s)[0])
        last = t
    assert np.allclose(out, alone[1], atol=1e-4)


# -- op2 ---------------------------------------------------------------------------------------------------------


def test_frequent_lines_go_and_depleted_documents_are_rejected(spark):
    body = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(30)]
    texts = [f"{b}\nShared  LINE of words" for b in body] + [("shared line\tof words\n" * 20) + " ".join(f"q{j}" for j in range(50))]
    docs = frame(spark, texts + ODD).withColumn("source", F.lit("h"))
    got = {r.doc_id: r for r in quality_rules.line_rules(docs, min_documents=5).collect()}
    assert all(got[i].removed_lines == [1] and got[i].kept for i in range(30))
    assert got[30].removed_words == 80 and got[30].n_dup_lines == 19 and not got[30].kept
    assert got[31].n_words == 0 and got[31].base_failed and not got[31].kept
    # a line of few documents in the hundred goes too where they are many
    assert not any(r.removed_lines for r in quality_rules.line_rules(docs, min_documents=5, max_share=0.9).collect())
    assert sum(bool(r.removed_lines) for r in quality_rules.line_rules(docs, min_documents=5, max_share=0.9, max_documents=25).collect()) == 31
    left = {r.doc_id: r.text for r in quality_rules.cleaned(docs, quality_rules.line_rules(docs, min_documents=5)).collect()}
    assert left[3] == body[3] and 30 not in left
    assert quality_rules.line_rules(docs.where("false")).count() == 0


# -- op3 ---------------------------------------------------------------------------------------------------------


def removed(texts, least):
    seen = collections.Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - least + 1):
            gone[i : i + least] |= seen[t[i : i + least]] > 1
        gone = gone[: len(t)]
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("largest", [4096, 3])
def test_repeats_match_brute_force(spark, monkeypatch, largest):
    monkeypatch.setattr(repeats, "CLASS", largest)
    draw = random.Random(largest)
    some = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    shared = [some(draw.randint(100, 300)) for _ in range(4)]
    texts = [*ODD, "x" * 99, "x" * 100, some(7) * 60]
    for _ in range(40):
        parts = []
        for _ in range(draw.randint(1, 3)):
            p, a = draw.choice(shared), draw.randint(0, 60)
            parts += [some(draw.randint(0, 90)), p[a : a + draw.randint(80, 300)]]
        texts.append("".join(parts))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(frame(spark, texts), least=100).collect()}
    want = removed([(t or "").encode() for t in texts], 100)
    assert [got[i] for i in range(len(texts))] == want
    assert repeats.remove_repeats(frame(spark, texts).where("false")).count() == 0


def test_repeats_in_documents_match_brute_force(spark):
    rows = queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op3_suffix_intervals(spark, "/root/testdata/sf0.001").collect()}
    assert [got[r.doc_id] for r in rows] == removed([(r.text or "").encode() for r in rows], 400)


def test_repeats_of_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(repeats, "WINDOWS", 1 << 12)
    monkeypatch.setattr(textkit, "SPAN_BYTES", 1 << 12)
    draw = random.Random(6)
    some = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    parts = [some(900), some(700)]
    texts = [some(9_000) + parts[0] + some(12_000) + parts[1] + some(5_000), some(300) + parts[0], parts[1][50:] + some(8_500) + parts[0], "x" * 20_000]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == removed([t.encode() for t in texts], 400)


def test_operators_take_long_texts(spark):
    """A text of some megabytes beside short ones goes through every operator on texts whole."""
    draw = np.random.default_rng(3)
    names = np.array([f"w{i}" for i in range(5000)])
    text = " ".join(names[draw.integers(0, 5000, 800_000)].tolist())
    docs = frame(spark, [text, text[:4_000_000], "short one"])
    labels = queries.table(spark, SF, "labels")
    assert {r.n_tokens for r in gated_lm.lm_scores(docs).collect()} >= {800_001, 3}
    assert quality_rules.line_rules(docs).where("n_words = 800000").count() == 1
    assert repeats.remove_repeats(docs).where("n_bytes > 4000000").count() == 1
    assert near_duplicates.near_duplicates(docs).where("n_shingles > 700000").count() == 1
    assert cotraining.classify(docs, labels, queries.metadata_columns()).count() == 3
    columns = (F.col("text"), F.lit(""), F.lit(""), F.lit(""), F.lit(""))
    assert language_id.identify(docs, queries.table(spark, SF, "documents"), "doc_id", *columns).where("n_grams > 100000").count() == 2
    assert packing.pieces(docs, queries.WORD_BPE).where("piece > 100").count() > 100


def test_intervals_are_the_prefix_tree():
    suffixes = sorted(["banana"[i:] for i in range(6)])
    lcp = [repeats.common(a.encode(), b.encode()) for a, b in zip(suffixes, suffixes[1:], strict=False)]
    assert sorted(repeats.intervals(lcp)) == [(0, 0, 5), (1, 0, 2), (2, 4, 5), (3, 1, 2)]


# -- op4 ---------------------------------------------------------------------------------------------------------


def components(sets, percent):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def test_near_duplicates_match_all_pairs(spark):
    draw = random.Random(2)
    base = [[f"w{draw.randint(0, 400)}" for _ in range(150)] for _ in range(4)]
    texts = list(ODD) + ["one", "ONE"]
    for _ in range(120):
        t = list(draw.choice(base))
        for _ in range(draw.randint(0, 12)):
            t[draw.randrange(len(t))] = f"z{draw.randint(0, 10**9)}"
        texts.append(" ".join(t))
    got = {r.doc_id: r for r in near_duplicates.near_duplicates(frame(spark, texts), k=4).collect()}
    sets = [{tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if (w := [x.lower() for x in words(t)]) else set() for t in texts]
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(texts))] == components(sets, 80)
    assert near_duplicates.near_duplicates(frame(spark, texts).where("false")).count() == 0


def test_rows_of_one_id_are_linked(spark):
    draw = random.Random(8)
    text = lambda: [f"w{draw.randint(0, 10**6)}" for _ in range(100)]
    a, b, c = text(), text(), text()
    near = lambda t: " ".join([*t[:-2], "new", "end"])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (2, near(a)), (3, near(b)), (5, None), (7, " ".join(c)), (9, near(c)), (9, near(c)), (8, "")]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: c for (i, _), c in got.items()} == {5: 2, 2: 2, 3: 2, 7: 7, 9: 7, 8: 8} and got[5, 0] == 2


# -- op5 ---------------------------------------------------------------------------------------------------------


def check_packing(rows, limit):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= limit
    return len(by)


def test_packing_is_whole_and_tight(spark):
    from tokenizers import Tokenizer

    path = queries.WORD_BPE
    texts = [*ODD, "It's İstanbul's naïve 12,345 don't! <|endoftext|> क़ é", "a <|endoftext|> b", "x<|startoftext|>y.<|ENDOFTEXT|> <|endoftext|>'s <| |>", "word " * 9000]
    docs = frame(spark, texts).union(spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id") + 1000, "text", "lang", "source", "n_chars", F.lit("k"), F.lit("n")))
    rows = packing.pack(packing.pieces(docs, path)).collect()
    assert check_packing(rows, 4096) <= -(-sum(r.length for r in rows) // 4096) + 2
    tokenizer = Tokenizer.from_file(path)
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == i)
        assert own == [(k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    assert packing.pack(packing.pieces(docs.where("false"), path)).count() == 0


def test_plan_places_every_piece():
    draw = np.random.default_rng(5)
    for n in (1, 2, 700):
        counts = np.bincount(np.minimum(np.exp(draw.normal(3, 1, n)).astype(int) + 1, 64), minlength=65)
        assert (np.bincount((p := packing.plan(counts, 64))[:, 0], p[:, 2], 65) == counts).all()


# -- op6 ---------------------------------------------------------------------------------------------------------


def test_cotraining_finds_held_out_toxic_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    held = F.pmod("doc_id", F.lit(4)) == 0
    scored = cotraining.classify(docs, labels.where(~held), queries.metadata_columns()).join(labels.where(held), "doc_id")
    toxic, clean = scored.where("toxic = 1"), scored.where("toxic = 0 AND quality = 1")
    assert toxic.where("NOT accepted").count() >= 0.9 * toxic.count()
    assert clean.where("accepted").count() >= 0.97 * clean.count()


def test_cotraining_edges(spark):
    docs, labels = frame(spark, ODD), queries.table(spark, SF, "labels")
    assert cotraining.classify(docs, labels.where("false"), queries.metadata_columns()).where("accepted").count() == len(ODD)
    assert cotraining.classify(docs, labels, queries.metadata_columns()).count() == len(ODD)
    assert cotraining.classify(docs.where("false"), labels, queries.metadata_columns()).count() == 0


def test_cotraining_exchanges_on_all_unlabelled_rows(spark):
    # each view tells the labelled rows apart; most of the others have words that no labelled row has
    good = F.col("id") % 2 == 0
    word = F.when(F.col("id") < 2_000, F.when(good, "fine solid").otherwise("junk spam")).otherwise(F.when(good, "fine rare").otherwise("junk odd"))
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.concat(word, F.lit(" a b")).alias("text"), F.when(good, "x").otherwise("y").alias("source"))
    labels = spark.range(1_000).select(F.col("id").alias("doc_id"), F.when(good, 1).otherwise(0).alias("quality"), F.lit(0).alias("toxic"))
    seen = []

    def spy(rows, weights, confident, real=cotraining.exchanged):
        seen.append((rows.count(), real(rows, weights, confident)))
        return seen[-1][1]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(cotraining, "exchanged", spy)
        cotraining.classify(docs, labels, [F.col("source"), F.lit("en")], confident=0.6)
    assert [n for n, _ in seen] == [11_000] * 3
    assert [(text.n_good, text.n_bad) for _, (text, _) in seen] == [(5_500, 5_500)] * 3
    more = spark.createDataFrame([(20_000, "rare", "z"), (20_001, "odd", "z")], docs.schema)
    p = {r.doc_id: r.p_text for r in cotraining.classify(docs.union(more), labels, [F.col("source"), F.lit("en")], confident=0.6).where("doc_id >= 20000").collect()}
    assert p[20_000] > p[20_001] + 0.1


# -- op7 ---------------------------------------------------------------------------------------------------------


def test_threshold_search_matches_all_scores(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in draw.integers(-3, 4, 6)]) for i in range(300)] + [(50, [1.0, 2.0]), (7, None), (8, [float("nan")] * 6), (9, [None] * 6), (400, [0.0] * 6), (100, [float("inf")] * 6)]
    got = collections.defaultdict(list)
    for r in threshold_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), row_block=64, query_block=3, scale=1).collect():
        got[r.query_id].append((r["rank"], r.score, r.vec_id))
    good = [(i, np.array(v + [0.0] * (6 - len(v)))) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    want = collections.defaultdict(list)
    for a, (i, v) in enumerate(good):
        if i % 50 == 0:
            best = sorted((-int(v @ u), j) for b, (j, u) in enumerate(good) if a != b)[:5]
            want[i] += [(k + 1, -s, j) for k, (s, j) in enumerate(best)]
    assert {k: sorted(x) for k, x in got.items()} == {k: sorted(x) for k, x in want.items()}


def test_threshold_search_of_large_components_and_of_nothing(spark):
    rows = [(50, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 0.5]), (3, [2.0**40, 0.0]), (4, [1e-9, -1e-9]), (5, [1e308, 0.0]), (6, [0.25, 3.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = {i: [int(x) * 256 if abs(x) > 2**53 else math.floor(x * 256) for x in v] for i, v in rows}
    own = exact.pop(50)
    want = sorted(((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in exact.items()))[:5]
    got = {(r.vec_id, r.score) for r in threshold_search.top_k(docs).collect()}
    assert got == {(i, min(max(-s, -(2**63)), 2**63 - 1)) for s, i in want}
    assert threshold_search.top_k(docs.where("false")).count() == 0


def test_threshold_search_stops_early():
    rows = np.diag(np.arange(1.0, 501.0))
    order = np.argsort(rows.T, axis=1, kind="stable")
    query = np.zeros(500)
    query[499] = 1
    ids, scores, met = threshold_search.threshold_top_k(query, 499, np.vstack([rows]), np.arange(500), np.arange(500), order, 1)
    assert len(ids) == 1 and met <= 500
    ids, scores, met = threshold_search.threshold_top_k(query, 0, rows, np.arange(500), np.arange(500), order, 1)
    assert (ids[0], scores[0]) == (499, 500) and met < 50


# -- op8 ---------------------------------------------------------------------------------------------------------


def test_ids_match_the_library(spark):
    import tiktoken

    path = queries.BYTE_BPE
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    texts = [*ODD, "I'll  go \n\n 12345 ٣٤ ½ 日本語 🎉 \x1c\x85 x   ", "a" * 3000 + " " + "ab" * 700]
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents").select((F.col("doc_id") + 1000).alias("doc_id"), "text", "lang", "source", "n_chars", F.lit("k"), F.lit("n")).union(frame(spark, texts))
    whole = {r.doc_id: r.text or "" for r in docs.collect()}
    got = byte_bpe.encode_texts(docs, path, public_tokenizers.PATTERN, with_ids=True, shared=500).collect()
    assert len(got) == len(whole) and byte_bpe.encode_texts(docs.where("false"), path, public_tokenizers.PATTERN).count() == 0
    for r in got:
        text = whole[r.doc_id]
        ids = own.encode_ordinary(text)
        assert (r.token_ids, bytes(r.decoded), r.n_tokens) == (ids, text.encode(), len(ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


# -- op9 ---------------------------------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    held = F.pmod("doc_id", F.lit(3)) == 0
    found = language_id.identify(docs.where(held).withColumnRenamed("lang", "gold"), docs.where(~held), "doc_id", F.col("text"), F.lit(""), F.lit(""), F.col("source"), F.col("source"), keep=["gold"])
    n, right = found.agg(F.count("*"), F.sum((F.col("lang") == F.col("gold")).cast("int"))).first()
    assert right >= 0.98 * n


def test_language_edges(spark):
    docs = frame(spark, ODD + ["漢字" * 50])
    labelled = queries.table(spark, SF, "documents")
    columns = (F.col("text"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("source"), F.lit(None).cast("string"))
    got = {r.doc_id: r for r in language_id.identify(docs, labelled, "doc_id", *columns).collect()}
    assert len(got) == len(ODD) + 1 and got[0].lang == got[1].lang == got[len(ODD)].lang == "und" and not got[0].accepted
    assert language_id.identify(docs, labelled.where("false"), "doc_id", *columns).where("lang = 'und'").count() == len(ODD) + 1
    assert language_id.identify(docs.where("false"), labelled, "doc_id", *columns).count() == 0


def test_rare_languages_of_large_tables_are_known(spark):
    text = F.when(F.col("id") % 2 == 0, "the cat and the dog of that house").otherwise("der hund und die katze von dem haus")
    many = spark.range(400_000).select(text.alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"))
    rare = spark.createDataFrame([("жылдыз тоо суу жана күн, бала мектепке барды", "KY")] * 300 + [("", "is"), (None, "xx")], "text string, lang string")
    docs = spark.createDataFrame([(1, "тоо жана суу, күн мектепке", "ky")], "doc_id long, text string, lang string")
    columns = (F.col("text"), F.col("lang"), F.lit(""), F.lit(""), F.lit(""))
    found = language_id.identify(docs, many.union(rare), "doc_id", *columns).collect()
    assert [(r.lang, r.declared) for r in found] == [("ky", "ky")]
    assert language_id.learned(many.union(rare), "text", "lang", 150)[0] == ["de", "en", "ky"]


# -- op10 --------------------------------------------------------------------------------------------------------


def test_url_rules_and_mined_rules(spark):
    urls = ["https://a.net/x", "https://Example.NET/en/1", "http://b.example.com/de/2?q", "https://c.org/fr/", "https://c.org/fr", "nothing", None, "https://notnet/x", "x://net"]
    bad = [f"https://shop{i}.example.info/cheap-pills/{i}" for i in range(30)]
    fine = [f"https://news{i}.example.info/story/{i}" for i in range(60)]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls + bad + fine)], "page_id long, url string, blocked string")
    labels = spark.createDataFrame([(i, int(i >= len(urls) + 30), 0) for i in range(len(urls), len(urls) + 90)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_filters.url_verdicts(pages, labels, queries.URL_RULES, min_hits=10).collect()}
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(urls))] == [
        ("a.net", "/x", "net/", "block"), ("example.net", "/en/1", "example.net/en/", "allow"), ("b.example.com", "/de/2", "example.com/de/", "block"), ("c.org", "/fr/", "org/fr/", "allow"),
        ("c.org", "/fr", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("notnet", "/x", None, "allow"), ("net", "", None, "allow"),
    ]
    assert {got[i].verdict for i in range(len(urls), len(urls) + 30)} == {"block"} and {got[i].verdict for i in range(len(urls) + 30, len(urls) + 90)} == {"allow"}
    assert url_filters.url_verdicts(pages, labels.where("false"), queries.URL_RULES).where("verdict = 'block'").count() == 2
    assert url_filters.url_verdicts(pages.where("false"), labels, queries.URL_RULES).count() == 0


def test_mined_sets_match_counted_ones(spark):
    import itertools

    draw = random.Random(4)
    rows = []
    for _ in range(400):
        tokens = sorted(draw.sample("abcdefg", draw.randint(0, 4)))
        rows.append((tokens, draw.random() < (0.8 if {"a", "b"} <= set(tokens) else 0.2)))
    counted, bad = collections.Counter(), collections.Counter()
    for tokens, blocked in rows:
        for n in range(1, 5):
            for some in itertools.combinations(tokens, n):
                counted[some] += 1
                bad[some] += blocked
    share = sum(b for _, b in rows) / len(rows)
    want = {}
    for some, hits in bad.items():
        above = hits - counted[some] * share
        if hits >= 8 and hits / counted[some] >= min(1.3 * share, (1 + share) / 2) and above > 0 and above**2 >= 4 * share * (1 - share) * counted[some]:
            want[some] = (round(hits / counted[some], 9), min(some, key=lambda x: (counted[(x,)], x)))
    got = {tuple(r["items"]): (round(r.confidence, 9), r["first"]) for r in url_filters.mined_rules(spark.createDataFrame(rows, "tokens array<string>, blocked boolean"), 0.0, 8, 1.3, 2.0).collect()}
    assert got == want and ("a", "b") in got
