"""A quality classifier by co-training of a text-content view and a page-metadata view.

Both views are logistic regressions over hashed features. In each round all unlabelled rows are scored in Spark tasks, a view
labels those that it is sure of, and the other view learns from them by sums per feature, whose size doesn't depend on the input's.
Both views' scores are then calibrated and combined by a logistic fit on labelled rows that took no part in training. Only the
labelled rows that are fitted one by one are a bounded sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.llm import textkit as T
from evidara.session import bounded_batches, cut

TEXT_BITS, META_BITS = 18, 12
#: Labelled ids up to which they are broadcast (16 bytes each); beyond, rows are joined with them by id.
BROADCAST_LABELS = 1_000_000
#: Places kept free at the end of the text view's features for measures of style, in tenths.
STYLE = 64
#: Rows that are worked on at once.
PART = 2000
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


@dataclass
class Model:
    """Weights of both views, biases, each view's calibration (weight, bias), and the fit (weight of the text view, of the metadata view,
    bias) that combines them."""

    text: np.ndarray
    meta: np.ndarray
    bias: tuple[float, float]
    views: tuple[tuple[float, ...], tuple[float, ...]]
    fit: tuple[float, ...]


def text_features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text): hashes of each text's distinct words, and its shares of signs, capitals and repeated words."""
    w = T.Words(data, at, T.IS_MARK)
    texts = len(at) - 1
    room = (1 << TEXT_BITS) - STYLE
    h = w.hashes(lower=True)
    key = np.unique((w.text.astype(np.int64) << 32) | (h >> T.U(32)).astype(np.int64))
    text, feature = key >> 32, (key & 0xFFFFFFFF) % room
    size = np.maximum(np.diff(at), 1)
    distinct = np.bincount(text, minlength=texts)
    upper = (data >= 65) & (data <= 90)
    style = [T.sums(PUNCTUATION[data], at) / size, T.sums(upper, at) / size, 1 - distinct / np.maximum(w.count, 1), np.log2(w.count + 1) / 20]
    for k, x in enumerate(style):
        feature = np.concatenate([feature, room + 16 * k + np.minimum((np.sqrt(x) * 15).astype(np.int64), 15)])
        text = np.concatenate([text, np.arange(texts)])
    return feature, text


def meta_hashes(metadata: list[Column]) -> Column:
    """An array of hashes, worked out in Spark: of each named value and of the pair of the first two; null is a value of its own."""
    values = [F.coalesce(m.cast("string"), F.lit("null")) for m in metadata]
    named = [F.concat(F.lit(f"{k}="), v) for k, v in enumerate(values)] + [F.concat(F.lit("both="), F.concat_ws("\t", *values[:2]))]
    return F.array(*(F.pmod(F.crc32(x), F.lit(1 << META_BITS)).cast("int") for x in named))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Rows:
    """Sparse binary rows: the features of row i are feature[first[i] : first[i + 1]]. They are worked on in parts of PART rows, so that
    little memory is needed besides the features."""

    def __init__(self, feature: np.ndarray, first: np.ndarray):
        self.feature, self.first, self.count = feature, first, len(first) - 1
        self.norm = 1 / np.sqrt(np.maximum(1, np.diff(first)))

    @staticmethod
    def of(feature: np.ndarray, row: np.ndarray, count: int) -> Rows:
        """Rows of pairs (feature, row) in any order."""
        return Rows(feature[np.argsort(row, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(row, minlength=count))]))

    @property
    def row(self) -> np.ndarray:
        """Each feature's row."""
        return np.repeat(np.arange(self.count), np.diff(self.first))

    def parts(self) -> Iterator[tuple[slice, Rows]]:
        for a in range(0, self.count, PART):
            b = min(self.count, a + PART)
            yield slice(a, b), Rows(self.feature[self.first[a] : self.first[b]], self.first[a : b + 1] - self.first[a])

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        out = np.empty(self.count)
        for at, part in self.parts():
            out[at] = np.bincount(part.row, weights[part.feature], part.count) * part.norm + bias
        return out

    def sums(self, x: np.ndarray, size: int) -> np.ndarray:
        """For each feature the sum of x over its rows."""
        out = np.zeros(size)
        for at, part in self.parts():
            out += np.bincount(part.feature, np.repeat(x[at], np.diff(part.first)), size)
        return out

    def take(self, rows: np.ndarray) -> Rows:
        begin, end = self.first[rows].tolist(), self.first[rows + 1].tolist()
        own = [self.feature[a:b] for a, b in zip(begin, end, strict=True)]
        return Rows(np.concatenate([self.feature[:0], *own]), np.concatenate([[0], np.cumsum(np.diff(self.first)[rows])]))


@dataclass
class Given:
    """Labels given by the other view: how many rows are good and bad, and how many of them have each feature."""

    good: np.ndarray
    bad: np.ndarray
    n_good: int
    n_bad: int


def logistic(rows: Rows, y: np.ndarray, size: int, given: Given | None = None, weight: float = 0.3, passes: int = 10, rate: float = 0.5, decay: float = 1e-6, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias by AdaGrad over shuffled small batches; y is 0 or 1.

    A feature's value is its smoothed log-odds between the classes, so that few telling features outweigh many common ones. Given labels
    enter the log-odds; each counts `weight`, and less where those of a class would then count more than half its labelled rows.
    Features that only rows with given labels have get half the weight that those of the labelled rows have on average.
    """
    w, g2 = np.zeros(size), np.full(size, 1e-8)
    n = [float(y.sum()), float((1 - y).sum())]
    sums = [rows.sums(x, size) for x in (y, 1 - y)]
    own = sums[0] + sums[1] > 0
    if given is not None:
        for k, (more, count) in enumerate(((given.good, given.n_good), (given.bad, given.n_bad))):
            each = min(weight, 0.5 * n[k] / max(count, 1))
            sums[k] = sums[k] + each * more
            n[k] += each * count
    odds = np.log((sums[0] + 1) / (n[0] + 2)) - np.log((sums[1] + 1) / (n[1] + 2))
    prior = float(np.clip(y.mean(), 0.01, 0.99))
    bias, b2 = float(np.log(prior / (1 - prior))), 1e-8
    draw = np.random.Generator(np.random.PCG64(seed))
    for _ in range(passes):
        for some in np.array_split(draw.permutation(rows.count), max(1, rows.count // 256)):
            part = rows.take(some)
            row = part.row
            value = odds[part.feature] * part.norm[row]
            d = (sigmoid(np.bincount(row, w[part.feature] * value, part.count) + bias) - y[some])
            used, where = np.unique(part.feature, return_inverse=True)
            g = np.bincount(where, d[row] * value, len(used)) + decay * w[used] * len(some)
            g2[used] += g * g
            w[used] -= rate * g / np.sqrt(g2[used])
            b2 += d.sum() ** 2
            bias -= rate * d.sum() / np.sqrt(b2)
    if given is not None:
        w[~own & (given.good + given.bad > 0)] = 0.5 * (w * odds * odds).sum() / max((odds * odds)[own].sum(), 1e-9)
    return w * odds, bias


def combine(x: np.ndarray, y: np.ndarray, passes: int = 500) -> tuple[float, ...]:
    """A logistic fit of y on the columns of x and a bias by Newton's method, slightly regularised."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.01] * (x.shape[1] - 1) + [1e-6])
    for _ in range(passes):
        p = sigmoid(x @ w)
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def fit(text: Rows, meta: Rows, y: np.ndarray, exchange: Callable[[list[tuple[np.ndarray, float]]], list[Given]], rounds: int) -> Model:
    """Co-training: y is 1 good, 0 bad. Every fifth row is kept for calibration. `exchange` takes both views' weights and biases and
    returns what each view is given by the other on all unlabelled rows."""
    every = np.arange(len(y))
    held, base = every[::5], np.setdiff1d(every, every[::5])
    if not len(base):
        return Model(np.zeros(1 << TEXT_BITS), np.zeros(1 << META_BITS), (0.0, 0.0), ((0.0, 20.0), (0.0, 20.0)), (0.0, 0.0, 20.0))
    target = y[base].astype(float)
    views = [(text.take(base), 1 << TEXT_BITS), (meta.take(base), 1 << META_BITS)]
    weights = [logistic(rows, target, size) for rows, size in views]
    for _ in range(rounds):
        given = exchange(weights)
        weights = [logistic(rows, target, size, labels) for (rows, size), labels in zip(views, given, strict=True)]
    x = np.column_stack([v.take(held).scores(*w) for v, w in zip((text, meta), weights, strict=True)])
    target = y[held].astype(float)
    return Model(weights[0][0], weights[1][0], (weights[0][1], weights[1][1]), (combine(x[:, :1], target), combine(x[:, 1:], target)), combine(x, target))


def list_rows(column: pa.Array) -> Rows:
    """A list column of features as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return Rows(column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])) if len(column) else Rows(np.zeros(0, np.int32), np.zeros(1, np.int64))


def exchanged(rows: DataFrame, weights: list[tuple[np.ndarray, float]], confident: float) -> list[Given]:
    """What each view is given by the other: the labels of all `rows` (features, meta_features) of which it is at least `confident`."""
    model = rows.sparkSession.sparkContext.broadcast([(w.astype(np.float32), b) for w, b in weights])

    def run(batches):
        sizes = [len(w) for w, _ in model.value]
        # good and bad; the last place counts rows
        total = [np.zeros((2, size + 1), np.int64) for size in sizes]
        for batch in batches:
            views = [list_rows(batch.column(k)) for k in range(2)]
            places = [v.row for v in views]
            for k in range(2):
                p = sigmoid(views[1 - k].scores(*model.value[1 - k]))
                for label, sure in enumerate((p >= confident, 1 - p >= confident)):
                    total[k][label, :-1] += np.bincount(views[k].feature[sure[places[k]]], minlength=sizes[k])
                    total[k][label, -1] += sure.sum()
        for k, v in enumerate(total):
            at = np.flatnonzero(v.any(0))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(v[0, at]), pa.array(v[1, at])], ["view", "feature", "good", "bad"])

    sums = rows.mapInArrow(T.tidied(run), "view int, feature int, good long, bad long").groupBy("view", "feature").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toArrow()
    view, feature, good, bad = (sums[c].to_numpy() for c in ("view", "feature", "good", "bad"))
    model.destroy()
    out = []
    for k, (w, _) in enumerate(weights):
        full = np.zeros((2, len(w) + 1), np.int64)
        full[:, feature[view == k]] = good[view == k], bad[view == k]
        out.append(Given(full[0, :-1], full[1, :-1], int(full[0, -1]), int(full[1, -1])))
    return out


def scored_rows(model: Model, feature: np.ndarray, row: np.ndarray, meta: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Calibrated P(good) by the text, by the metadata, and by both."""
    a = Rows.of(feature, row, meta.count).scores(model.text, model.bias[0])
    b = meta.scores(model.meta, model.bias[1])
    (p, q), (r, t), (u, v, c) = *model.views, model.fit
    return sigmoid(p * a + q), sigmoid(r * b + t), sigmoid(u * a + v * b + c)


def classify(docs: DataFrame, labels: DataFrame, metadata: list[Column], id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", good: Column | None = None, max_labelled: int = 12_000, rounds: int = 3, confident: float = 0.95, least: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """(id, p_text, p_meta, score, accepted, and the columns `keep`) per row of `docs`; score is P(good) by both views.

    Labelled are the rows whose id is in `labels`; `good` is a condition on `labels` (quality is 1 and toxic isn't 1), null in no
    row that counts; an id is good if all its rows are. Fitted one by one are at most about `max_labelled` labelled ids,
    chosen by a hash of the id, each with one of its rows; all rows without a label take part in every round. Null texts are empty and null metadata a value of its own. Without
    labels every row is accepted. Rows with the same id are scored one by one; texts may have any length; columns other than those named
    play no part; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    good = (F.col("quality") == 1) & ~F.coalesce(F.col("toxic") == 1, F.lit(False)) if good is None else good
    said = labels.select(F.col(label_id).alias("__id"), good.cast("int").alias("__y")).where("__id IS NOT NULL AND __y IS NOT NULL").groupBy("__id").agg(F.min("__y").alias("__y"))
    said = cut(said)
    n_labels = said.count()
    ids = said.select("__id")
    if n_labels <= BROADCAST_LABELS:
        said, ids = F.broadcast(said), F.broadcast(ids)
    keep = keep or []
    values = meta_hashes(metadata)
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"), values.alias("meta"))
    whole = 1 << 62
    at = F.pmod(F.xxhash64(F.col("__id"), F.lit(5)), F.lit(whole))
    share = min(whole, whole * max_labelled // max(1, n_labels))

    def features(batches):
        for part, data, offsets in T.slices(batches):
            feature, text = text_features(data, offsets)
            features = T.lists(feature[np.argsort(text, kind="stable")].astype(np.int32), np.bincount(text, minlength=part.num_rows))
            yield pa.RecordBatch.from_arrays([part.column(0), features, part.column(2)], ["__id", "features", "meta_features"])

    id_type = docs.schema[id_col].dataType.simpleString()
    made = lambda rows: rows.select("__id", "text", "meta").mapInArrow(T.tidied(features), f"__id {id_type}, features array<int>, meta_features array<int>")
    # an id's rows count as one, whatever their number: that of the least features
    fitted = made(source.where(at < share).join(ids, "__id", "left_semi")).groupBy("__id").agg(F.min(F.struct("features", "meta_features")).alias("r"))
    rows = fitted.join(said, "__id").select("__id", "r.features", "r.meta_features", "__y").toArrow()
    order = np.argsort(np.array([str(x) for x in rows["__id"].to_pylist()], dtype=object), kind="stable")
    views = [list_rows(rows[c]).take(order) for c in ("features", "meta_features")]
    y = rows["__y"].to_numpy()[order]
    del rows  # the driver holds the features once
    free = None

    def exchange(weights: list[tuple[np.ndarray, float]]) -> list[Given]:
        nonlocal free
        if free is None:
            free = cut(made(source).join(ids, "__id", "left_anti").select("features", "meta_features"))
        return exchanged(free, weights, confident)

    model = docs.sparkSession.sparkContext.broadcast(fit(*views, y, exchange, rounds))
    views.clear()
    T.trim()

    def judge(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, meta in columns:
            made = [np.zeros((3, 0))]
            for part, data, offsets in T.slices([pa.RecordBatch.from_arrays([text, meta], ["text", "meta"])]):
                made.append(np.stack(scored_rows(model.value, *text_features(data, offsets), list_rows(part.column(1)))))
            yield pa.StructArray.from_arrays([pa.array(x) for x in np.concatenate(made, 1)], ["p_text", "p_meta", "score"])

    # only text and metadata go to Python and only the scores come back
    judged = F.arrow_udf(judge, "p_text double, p_meta double, score double")(F.col(text_col), values)
    found = docs.select(F.col(id_col).alias("__id"), *(F.col(c).alias(f"__keep_{c}") for c in keep), judged.alias("__s"))
    return found.select(F.col("__id").alias(id_col), *(F.col(f"__keep_{c}").alias(c) for c in keep), "__s.p_text", "__s.p_meta", "__s.score", (F.col("__s.score") >= least).alias("accepted"))
