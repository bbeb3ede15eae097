"""Co-training against plain Python: loops over rows and features, with dictionaries for weights."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evidara.llm import cotraining as C
from evidara.llm import textkit as T

CONFIDENT = 0.8


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def value(weights, bias, features):
    return sum(weights.get(f, 0.0) for f in features) / math.sqrt(max(1, len(features))) + bias


def plain_logistic(rows, y, given=None):
    n = [sum(y), len(y) - sum(y)]
    sums = [Counter(), Counter()]
    for features, label in zip(rows, y, strict=True):
        sums[0 if label else 1].update(features)
    own = set(sums[0]) | set(sums[1])
    if given:
        for k in (0, 1):
            each = min(0.3, 0.5 * n[k] / max(given[k][1], 1))
            for f, more in given[k][0].items():
                sums[k][f] += each * more
            n[k] += each * given[k][1]
    every = set(sums[0]) | set(sums[1])
    odds = {f: math.log((sums[0][f] + 1) / (n[0] + 2)) - math.log((sums[1][f] + 1) / (n[1] + 2)) for f in every}
    rest = math.log(1 / (n[0] + 2)) - math.log(1 / (n[1] + 2))  # of features that no row has
    prior = min(0.99, max(0.01, sum(y) / len(y)))
    w, g2, bias, b2 = Counter(), {}, math.log(prior / (1 - prior)), 1e-8
    draw = np.random.Generator(np.random.PCG64(1))
    for _ in range(10):
        for some in np.array_split(draw.permutation(len(rows)), max(1, len(rows) // 256)):
            g, d_sum = Counter(), 0.0
            for i in some:
                norm = 1 / math.sqrt(max(1, len(rows[i])))
                d = sigmoid(sum(w[f] * odds[f] * norm for f in rows[i]) + bias) - y[i]
                d_sum += d
                for f in rows[i]:
                    g[f] += d * odds[f] * norm
            for f in list(g):
                step = g[f] + 1e-6 * w[f] * len(some)
                g2[f] = g2.get(f, 1e-8) + step * step
                w[f] -= 0.5 * step / math.sqrt(g2[f])
            b2 += d_sum**2
            bias -= 0.5 * d_sum / math.sqrt(b2)
    if given:
        level = 0.5 * sum(w[f] * odds[f] ** 2 for f in own) / max(sum(odds[f] ** 2 for f in own), 1e-9)
        for f in (set(given[0][0]) | set(given[1][0])) - own:
            w[f] = level
    assert math.isfinite(rest)
    return {f: w[f] * odds[f] for f in w}, bias


def plain_cotraining(views, labels, rounds):
    """views: (text features, metadata features) by id; labels: 0 or 1 by id. The scores (p_text, p_meta, score) by id."""
    ids = sorted(labels, key=str)
    held, base = ids[::5], [i for i in ids if i not in ids[::5]]
    y = [labels[i] for i in base]
    models = [plain_logistic([views[i][k] for i in base], y) for k in (0, 1)]
    free = [i for i in views if i not in labels]
    for _ in range(rounds):
        given = []
        for k in (0, 1):
            p = {i: sigmoid(value(*models[1 - k], views[i][1 - k])) for i in free}
            sure = [[i for i in free if p[i] >= CONFIDENT], [i for i in free if 1 - p[i] >= CONFIDENT]]
            given.append([(Counter(f for i in some for f in views[i][k]), len(some)) for some in sure])
        models = [plain_logistic([views[i][k] for i in base], y, given[k]) for k in (0, 1)]
    x = np.array([[value(*models[k], views[i][k]) for k in (0, 1)] for i in held])
    target = np.array([float(labels[i]) for i in held])
    fits = [C.combine(x[:, :1], target), C.combine(x[:, 1:], target), C.combine(x, target)]
    out = {}
    for i, v in views.items():
        a, b = (value(*models[k], v[k]) for k in (0, 1))
        out[i] = sigmoid(fits[0][0] * a + fits[0][1]), sigmoid(fits[1][0] * b + fits[1][1]), sigmoid(fits[2][0] * a + fits[2][1] * b + fits[2][2])
    return out


def test_cotraining_matches_plain_python(spark):
    draw = random.Random(12)
    good, bad, both = "clear steady useful plain sound".split(), "spam click cheap win free".split(), "the of and to in it on at".split()
    rows, labels = [], []
    for i in range(220):
        y = draw.random() < 0.6
        words = [draw.choice(both) for _ in range(draw.randint(5, 25))] + [draw.choice(good if y != (draw.random() < 0.15) else bad) for _ in range(draw.randint(1, 4))]
        text = None if i == 7 else " ".join(draw.sample(words, len(words)))
        rows.append((i, text, "news" if (draw.random() < 0.8) == y else "shop", draw.choice(["en", "de", None])))
        if i < 90:
            labels.append((i, int(y), 0))
    docs = spark.createDataFrame([*rows, rows[3], (3, "another text of the id", "shop", "en")], "doc_id long, text string, source string, lang string").repartition(3)
    metadata = [F.col("source"), F.col("lang")]
    scored = C.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), metadata, rounds=2, confident=CONFIDENT).collect()
    hashes = {r.doc_id: r.m for r in docs.select("doc_id", C.meta_hashes(metadata).alias("m")).collect()}
    texts = [t or "" for _, t, *_ in rows]
    feature, row = C.text_features(*T.text_buffers(pa.array(texts)))
    own = [sorted(feature[row == k].tolist()) for k in range(len(rows))]
    views = {i: (own[k], hashes[i]) for k, (i, *_) in enumerate(rows) if i != 3}
    # the id with two texts: the fit takes the row of least features, and each row is scored for itself
    other = C.text_features(*T.text_buffers(pa.array(["another text of the id"])))[0].tolist()
    metas = [r.m for r in docs.where("doc_id = 3").select(C.meta_hashes(metadata).alias("m")).distinct().collect()]
    shop = next(m for m in [[r.m for r in docs.where("doc_id = 3 AND text LIKE 'another%'").select(C.meta_hashes(metadata).alias("m")).collect()][0]] if m)
    first = next((m for m in metas if m != shop), shop)
    order = C.text_features(*T.text_buffers(pa.array([texts[3]])))[0].tolist()
    views[3] = min((order, first), (other, shop))
    want = plain_cotraining({i: (list(v[0]), list(v[1])) for i, v in views.items()}, {i: y for i, y, _ in labels}, 2)
    got = {}
    for r in scored:
        got.setdefault(r.doc_id, []).append((r.p_text, r.p_meta, r.score))
    assert len(scored) == 222 and len(got[3]) == 3
    for i, w in want.items():
        assert any(g == pytest.approx(w, abs=2e-3) for g in got[i]), (i, got[i], w)
    assert sum((g[0][2] >= 0.5) == bool(y) for i, y, _ in labels for g in [got[i]]) > 75
