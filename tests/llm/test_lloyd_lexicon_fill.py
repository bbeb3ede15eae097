"""Brute force, round trips and edge cases for clustering, the toxicity lexicon and fill-in-middle; tables of texts without words."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from evidara.llm import byte_bpe, centroids, cotraining, fill_middle, gated_lm, language_id, near_duplicates, packing, quality_rules, queries, repeats, toxicity

VECTORS = "vec_id long, embedding array<float>, label int, cluster string, id string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, term string, label int"


# -- op11 --------------------------------------------------------------------------------------------------------


def plain_lloyd(rows, k, rounds, scale, size, seed="3"):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: ("g" if r[0] is None else hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    c = [list(v) for _, v in first[:k]]

    def near(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, x, strict=True)) for x in c]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        at = [near(v)[0] for _, v in kept]
        for j in range(len(c)):
            own = [v for (_, v), a in zip(kept, at, strict=True) if a == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = [sum(d for _, a, d in found if a == j) for j in range(len(c))]
    return sorted(((i, a, d, inertia[a], sum(inertia), hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest()) for i, a, d in found), key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", "i") for i, v in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("scale", [1024, 10])
def test_lloyd_matches_a_plain_loop(spark, scale):
    draw = random.Random(4)
    # ties, repeated rows and ids, a null id, and vectors that don't count
    rows = [(i, [draw.choice([-1.5, -0.25, 0.125, 2.0]) for _ in range(3)]) for i in range(60)]
    rows += [(5, rows[5][1]), (7, [9.0, 9.0, 9.0]), (None, [0.5, 0.5, 0.5]), (70, None), (71, [1.0, 2.0]), (72, [1.0, None, 2.0]), (73, [1.0, math.nan, 2.0]), (74, [math.inf, 0.0, 0.0]), (75, [])]
    got = centroids.lloyd(vectors(spark, rows), k=5, rounds=6, scale=scale, size=3).collect()
    assert sorted(map(tuple, got), key=str) == plain_lloyd(rows, 5, 6, scale, 3)


def test_lloyd_of_huge_components_is_exact(spark):
    rows = [(i, [float(x), float(i % 3)]) for i, x in enumerate([1e6, 3e5, -2e6, 5e5, 7.0, 9.0, 2.0**25, -(2.0**26)])]
    got = centroids.lloyd(vectors(spark, rows), k=3, rounds=4, scale=1024, size=2).collect()
    assert [(r.vec_id, r.cluster, r.centroid_sha256) for r in sorted(got, key=lambda r: r.vec_id)] == [(r[0], r[1], r[5]) for r in sorted(plain_lloyd(rows, 3, 4, 1024, 2))]
    beyond = centroids.lloyd(vectors(spark, [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.0])]), k=1, rounds=1, scale=1024, size=2).collect()
    assert len(beyond) == 3 and all(r.cluster_inertia is None and r.inertia is None for r in beyond)


def test_lloyd_with_few_or_no_vectors(spark):
    assert centroids.lloyd(vectors(spark, [(1, [1.0])])).count() == 0
    assert centroids.lloyd(vectors(spark, [(1, [1.0])]).where("false")).count() == 0
    got = centroids.lloyd(vectors(spark, [(1, [1.0, 2.0]), (2, [5.0, 5.0])]), size=2, k=8).collect()
    assert sorted((r.vec_id, r.distance) for r in got) == [(1, 0), (2, 0)]


def test_lloyd_parts_add_up():
    import numpy as np

    total = np.array([-(1 << 70), 5, (1 << 65) + 12345, -1], object)
    assert sum((p << (centroids.PART * k)) for k, p in enumerate(centroids.parts(total, True))).tolist() == total.tolist()


# -- op12 --------------------------------------------------------------------------------------------------------

CLEAN = "the river ran past quiet fields where people walked and talked about weather music bread maps stone".split()


def sample(n=400, seed=2):
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [draw.choice(CLEAN) + draw.choice(["", "s", "ing"]) for _ in range(draw.randint(20, 80))]
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(["blorg", "vaxnit", "blorgish"]))
        if i % 5 == 1:  # harmless words that begin like an entry
            words.insert(draw.randrange(len(words)), "blorgonia")
        docs.append((i, " ".join(words), "en", "s", 0, "t", 9))
        if i % 3:
            labels.append((i, int(toxic)))
    return docs, labels


def test_folding():
    same = ["You 1d10t", "you ѕсum", "ｙｏｕ ｉｄｉｏｔ", "y​ou ïdìöt", "$cum @ss", "to$$$ the&&& 1053", "b@d,foo", "", "  \n", "12"]
    assert [toxicity.folded(x) for x in same] == [" you idiot ", " you scum ", " you idiot ", " you idiot ", " scum ass ", " to the ", " bad foo ", "", "", ""]
    long = "word " * 500_000
    assert "".join(toxicity.folded_parts(long)).count("word") == 500_000


def test_longest_entry_counts_and_exceptions_do_not():
    lexicon = toxicity.Lexicon({" ass": 1.0, " asshat": 3.0, " scum ": 2.0}, frozenset({" assembly ", " pond scum ", " kick ass and "}))
    made = lexicon.automaton()
    found = lambda text: [w for _, _, w in toxicity.matches(toxicity.folded(text), made)]
    assert found("You asshat, scum") == [3.0, 2.0]
    assert found("the assembly of pond scum") == []
    assert found("scum of the pond") == [2.0]
    assert found("kick ass and go, ass") == [1.0]
    assert found("scummy bass") == []
    assert toxicity.evidence("scum scum", None) == (0.0, 2)


def test_lexicon_is_learned_and_disguises_are_caught(spark):
    docs, labels = sample()
    disguised = [(1000, "the quiet " + "bl0rg v@xn1t " * 2 + "river " * 20, None, None, None, "t", 0), (1001, "river " * 30 + "blоrg " * 3, None, None, None, "t", 0), (1002, None, None, None, None, "t", 0), (1003, "", None, None, None, "t", 0), (1004, "past blorgonia " * 5, None, None, None, "t", 0)]
    frame = spark.createDataFrame(docs + disguised + docs[:2], DOCS)
    rows = toxicity.toxicity(frame, spark.createDataFrame(labels, "doc_id long, toxic int"), least_docs=3, gain=15.0).collect()
    assert len(rows) == len(docs) + len(disguised) + 2
    got = {r.doc_id: r for r in rows}
    for i, *_ in docs:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i].predicted == int(i % 4 == 0), (i, got[i])
    assert [got[i].predicted for i in range(1000, 1005)] == [1, 1, 0, 0, 0]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = sample()
    frame = spark.createDataFrame(docs, DOCS)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a, b = ({r.doc_id: r.score for r in toxicity.toxicity(frame, spark.createDataFrame(x, "doc_id long, toxic int"), least_docs=3, gain=15.0).collect()} for x in (labels, flipped))
    assert a == b


def test_toxicity_without_labels_or_rows(spark):
    frame, none = spark.createDataFrame(sample(20)[0], DOCS), spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(frame, none).collect()} == {0}
    assert toxicity.toxicity(frame.where("false"), none).count() == 0
    given = toxicity.toxicity(frame, none, exceptions=["pond scum", ""])
    assert given.columns == ["doc_id", "held_out", "score", "predicted", "matched", "n_words"] and given.count() == 20


def test_held_out_toxicity(spark):
    got = queries.op12_toxic_lexicon(spark, "/root/testdata/sf0.1").where("held_out").join(queries.table(spark, "/root/testdata/sf0.1", "labels"), "doc_id")
    r = got.groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    p = {x.toxic: x.p for x in r}
    assert p[1] > 0.75 and p[0] < 0.01


# -- op13 --------------------------------------------------------------------------------------------------------

TEXTS = [None, "", "a", "ab", "\n\r\n\x00", "é漢字😀" * 40, "x" * 1025, "has <P> inside", "<S>", "<M", "plain words and more " * 100, "é́" * 300, " line" * 129]


@pytest.mark.parametrize("run", [1, 3, 512])
def test_fill_middle_matches_slices(spark, run):
    frame = spark.createDataFrame([(i if i < 200 else None, TEXTS[i % len(TEXTS)], "en", "s", 1, "t", 0) for i in range(210)], DOCS)
    rows = fill_middle.fill_middle(frame, run=run).collect()
    assert len(rows) == 210
    seen = set()
    for r in rows:
        text = TEXTS[r.doc_id % len(TEXTS)] or "" if r.doc_id is not None else None
        if text is None:
            continue
        h = [int(hashlib.sha256(f"1:{r.doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
        a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
        form = "plain" if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
        p, m, s = text[:a], text[a:b], text[b:]
        out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == (len(text), form, None if form == "plain" else a, None if form == "plain" else b - a, out)
        assert fill_middle.restore(r.output, r.form) == text
        seen.add(form)
    assert seen == {"plain", "psm", "spm"}


def test_units_of_long_texts():
    text = "".join(random.Random(1).choice("ab\né漢😀") for _ in range(5000))
    for run, block in ((1, 64), (7, 70), (512, 1024), (512, 1 << 16)):
        u = fill_middle.Units(text, run, block)
        assert u.n == len(text) and [u.end_of(k) for k in (0, 1, 69, 70, 71, 1024, 4999, 5000)] == [0, 1, 69, 70, 71, 1024, 4999, 5000]


def test_fill_middle_of_an_empty_table(spark):
    frame = spark.createDataFrame([(1, "a", "en", "s", 1, "t", 0)], DOCS).where("false")
    assert fill_middle.fill_middle(frame).count() == 0 == fill_middle.fill_middle(frame, digests=True).count()


# -- tables of texts without words -------------------------------------------------------------------------------


def test_texts_without_words_in_one_partition(spark):
    frame = spark.createDataFrame([(1, None, None, None, None, "t", 0), (2, "", "en", "s", 0, "t", 0), (3, " \n\t", "en", "s", 3, "t", 0)], DOCS).coalesce(1)
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    none = F.lit("")
    made = [
        gated_lm.lm_scores(frame), quality_rules.line_rules(frame), repeats.remove_repeats(frame), near_duplicates.near_duplicates(frame),
        packing.pack(packing.pieces(frame, queries.WORD_BPE)), cotraining.classify(frame, labels, [F.col("source")]), byte_bpe.encode_texts(frame, queries.BYTE_BPE, queries.public_tokenizers.PATTERN),
        language_id.identify(frame, frame, "doc_id", F.col("text"), F.col("lang"), none, F.col("source"), F.col("source")), toxicity.toxicity(frame, labels), fill_middle.fill_middle(frame),
    ]
    assert [df.count() for df in made] == [3] * len(made)
