"""What the driver and the workers hold or send to a tokenizer: it stays small whatever the rows."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from evidara.llm import cotraining, gated_lm, packing, queries


def peak_mb(run):
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return most


def test_a_fit_holds_little_besides_its_features():
    draw = np.random.Generator(np.random.PCG64(3))
    text = pa.array(list(draw.integers(0, 1 << cotraining.TEXT_BITS, (12_000, 120), dtype=np.int32)), pa.list_(pa.int32()))
    meta = pa.array(list(draw.integers(0, 1 << cotraining.META_BITS, (12_000, 6), dtype=np.int32)), pa.list_(pa.int32()))
    y = draw.integers(0, 2, 12_000)
    # 6 MB of features; it took 81 MB when each was held with its row in 64 bits and sorted
    assert peak_mb(lambda: cotraining.fit(cotraining.list_rows(text), cotraining.list_rows(meta), y, None, 0)) < 60


def test_outputs_of_many_states_are_worked_out_in_parts():
    s = gated_lm.Settings(n_single=64, n_classes=8, n_suffix=92, hidden=4)
    draw = np.random.Generator(np.random.PCG64(3))
    p = {k: draw.standard_normal(shape).astype(np.float32) for k, shape in (("Wc", (4, 100)), ("bc", 100), ("Ww", (8, 4, 8)), ("bw", (8, 8)))}
    states, target = draw.standard_normal((100_000, 4)).astype(np.float32), draw.integers(0, 156, 100_000)
    assert peak_mb(lambda: gated_lm.log_likelihood(p, states, target, s)) < 20  # all at once took 80 MB
    x = states.astype(float) @ p["Wc"] + p["bc"]
    want = (x - np.log(np.exp(x).sum(1, keepdims=True)))[np.arange(len(x)), gated_lm.class_of(target, s)]
    for i in np.flatnonzero(target < s.n_single):
        z = states[i].astype(float) @ p["Ww"][target[i] // 8] + p["bw"][target[i] // 8]
        want[i] += z[target[i] % 8] - np.log(np.exp(z).sum())
    assert np.abs(gated_lm.log_likelihood(p, states, target, s) - want).max() < 1e-4


def lm_vocabulary(n):
    s = gated_lm.Settings()
    draw = np.random.Generator(np.random.PCG64(5))
    keys = np.sort(draw.integers(-(2**63), 2**63 - 1, n))
    v = gated_lm.Vocabulary(keys, np.arange(n), np.full(n, -1), np.zeros(n, int), np.ones(s.n_suffix), 9, n, s)
    v.start_class, v.start_word = np.zeros(s.n_classes + s.n_suffix, np.float32), np.zeros((s.n_classes, s.per_class), np.float32)
    return v, draw


def test_windows_use_the_same_memory_again_and_classes_are_not_exponentiated_one_by_one(monkeypatch):
    v, draw = lm_vocabulary(4)
    s = v.settings
    trainer, room = gated_lm.Trainer(gated_lm.fresh_weights(v), s, s.rate), gated_lm.Room()
    x, y = (draw.integers(0, s.n_single + s.n_suffix, (s.window, s.lanes)).astype(np.uint16) for _ in range(2))
    fresh, live, h = np.zeros(x.shape, bool), np.ones(x.shape, bool), np.zeros((s.lanes, s.hidden), np.float32)

    def window():
        return gated_lm.gradients(trainer.p, h, x, y, fresh, live, s, room)

    g, _ = window()
    kept = {k: d.copy() for k, d in g.items()}
    calls, exp = [], np.exp
    with monkeypatch.context() as m:
        m.setattr(np, "exp", lambda a, **more: (calls.append(a.size), exp(a, **more))[1])
        g, _ = window()
    assert len(calls) <= 2 * s.window + 1  # 41: the steps, the classes by parts, all words within their classes; 53 before, with one for each class
    assert all(np.array_equal(g[k], kept[k]) for k in kept)
    assert peak_mb(window) < 5  # 3.0 MB; 7.6 before


def test_large_outputs_do_not_overflow():
    s = gated_lm.Settings(n_single=64, n_classes=8, n_suffix=5, hidden=4)
    draw = np.random.Generator(np.random.PCG64(7))
    big = {k: (draw.standard_normal(shape) * 60).astype(np.float32) for k, shape in (("Wc", (4, 13)), ("bc", 13), ("Ww", (8, 4, 8)), ("bw", (8, 8)))}
    big |= {k: draw.standard_normal(shape).astype(np.float32) for k, shape in (("E", (69, 12)), ("U", (4, 12)))}
    x, y = draw.integers(0, 69, (6, 50)), draw.integers(0, 69, (6, 50))
    fresh, live = draw.random((6, 50)) < 0.2, draw.random((6, 50)) < 0.9
    got, h = gated_lm.gradients(big, np.zeros((50, 4), np.float32), x, y, fresh, live, s)
    want, _ = gated_lm.gradients({k: d.astype(np.float64) for k, d in big.items()}, np.zeros((50, 4)), x, y, fresh, live, s)
    for k in got:
        assert np.isfinite(got[k]).all() and np.abs(got[k] - want[k]).max() < 1e-3 * max(1e-3, np.abs(want[k]).max()), k
    assert np.isfinite(gated_lm.log_likelihood(big, h, y[0], s)).all()


def test_words_are_found_by_their_highest_bits():
    for n in (1, 2, 5000):
        v, draw = lm_vocabulary(n)
        h = np.concatenate([v.keys, v.keys + 1, v.keys - 1, draw.integers(-(2**63), 2**63 - 1, 1000), [-(2**63), 2**63 - 1]])
        assert (v.places(h) == np.minimum(np.searchsorted(v.keys, h), n - 1)).all()
    v.keys = np.arange(900)  # keys that share all of them
    del v.leads
    assert (v.places(np.arange(-5, 950)) == np.clip(np.arange(-5, 950), 0, 899)).all()


class Recorded:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_runs_of_latin_letters_need_no_patterns():
    words = packing.WordIds(queries.WORD_BPE)
    whole, words.tokenizer = words.tokenizer, (asked := Recorded(words.tokenizer))
    words.learn([x.encode() for x in ("Straße,", "ÑANDÚ", "plain", "Ünï!", "слово", "a1")])
    assert sorted(x for text in asked.texts for x in text.split()) == ["!", ",", "a1", "слово"]
    draw = random.Random(1)
    signs = [chr(i) for i in [*range(32, 127), *range(0xA0, 0x180)]] + [*" \t\n  ", *"'.,İßſΣςи中é\u0085ªµ×÷ŉ", "é", "<|endoftext|>", "<|"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(120))) for _ in range(500)]
    got = words.ids_of([x.encode() for x in texts])
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text
