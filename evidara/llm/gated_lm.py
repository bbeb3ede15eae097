"""A gated recurrent language model with a class-factored softmax, trained and applied as Spark jobs.

Tokens are lower-cased words and one end per document. The `n_single` most frequent tokens have an output of their own and lie in
classes of equal size; every other token belongs to a class given by its last two bytes, within which it has the share
(count + 1) / (sum of count + 1, plus 1 for words never seen). So P(text) is a proper distribution over the words met in training and,
for each class of endings, one place for a word not met, to which every such word is counted:

    P(token | state) = P(class | state) * P(token | class, state)

Counts cover all training texts and are never gathered in one place: the words above a count that at most `head_words`
words exceed are broadcast, all others are looked up by a join on their hash. Weights come from a data-parallel pass
over all training texts in a few rounds: in each, every task trains by truncated backpropagation on its share of the
round's texts, from the same weights, and the results are averaged by number of tokens in a tree.
"""

from __future__ import annotations

import bisect
import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidara.llm import textkit as T
from evidara.session import bounded_batches, cut

#: The end token's key.
END = int(T.signed(T.mix(np.array([0x454E44], T.U)))[0])
#: Distinct words that a task counts before it hands them on.
COUNTED = 400_000
#: States scored at once; states whose outputs are worked out at once, so that they stay in the processor's cache.
BLOCK, PART = 4096, 256
#: Sums of exponentials of numbers up to this don't overflow, nor vanish, in 32 bits.
SAFE = 60.0
#: Tokens scored at once: the longest texts of so many end alone.
SCORED = 4_000_000


@dataclass(frozen=True)
class Settings:
    """n_single tokens with outputs of their own in n_classes classes; n_suffix classes for the rest."""

    n_single: int = 1024
    n_classes: int = 32
    n_suffix: int = 64
    hidden: int = 16
    window: int = 20
    lanes: int = 256
    rate: float = 0.01
    head_words: int = 200_000
    rounds: tuple[int, ...] = (1, 3, 12)
    seed: int = 3
    fan_in: int = 32

    @property
    def per_class(self) -> int:
        return self.n_single // self.n_classes


def suffix_class(w: T.Words, n: int) -> np.ndarray:
    """Each word's class by its last two bytes, A-Z lower-cased."""
    last = T.LOWER[w.data[w.end - 1]].astype(np.int64)
    before = np.where(w.end - w.start > 1, T.LOWER[w.data[np.maximum(w.end - 2, 0)]], 0).astype(np.int64)
    return (((last * 257 + before) * 2654435761) >> 12) % n


# -- counts ------------------------------------------------------------------------------------------------------


def word_counts(texts: DataFrame, n_suffix: int) -> DataFrame:
    """(h, s, n): each token of the texts, its suffix class (-1: end), its number of occurrences."""

    def run(batches):
        def out(h, s, n):
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(s.astype(np.int32)), pa.array(n)], ["h", "s", "n"])

        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        ends = 0
        for _, data, at in T.slices(batches):
            ends += len(at) - 1
            w = T.Words(data, at)
            h = T.signed(w.hashes(lower=True))
            kept.append(summed(h, suffix_class(w, n_suffix), np.ones(len(h), np.int64)))
            if sum(len(x[0]) for x in kept) > COUNTED:
                kept = [merged(kept)]
                if len(kept[0][0]) > COUNTED // 2:
                    yield out(*kept.pop())
        if kept:
            yield out(*merged(kept))
        if ends:
            yield out(np.array([END]), np.array([-1]), np.array([ends]))

    def merged(parts):
        return summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    def summed(h, s, n):
        # equal words have one suffix class, so any order of theirs will do
        order = np.argsort(h)
        h = h[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
        return h[first], s[order[first]], np.add.reduceat(n[order], first) if len(h) else n

    return texts.select("text").mapInArrow(run, "h long, s int, n long").groupBy("h").agg(F.first("s").alias("s"), F.sum("n").alias("n"))


def bin_of(n):
    """Eighths of the binary logarithm: counts below 2 ** 3 have bins of their own."""
    return F.floor(F.log2(n.cast("double")) * 8).cast("int")


# -- the network -------------------------------------------------------------------------------------------------


@dataclass
class Vocabulary:
    """Head words by sorted key: count, output (-1: none), suffix class. Sums over suffix classes. Totals."""

    keys: np.ndarray
    counts: np.ndarray
    single: np.ndarray
    suffix: np.ndarray
    rest: np.ndarray
    tokens: int
    types: int
    settings: Settings
    start_class: np.ndarray = field(default=None)
    start_word: np.ndarray = field(default=None)

    @property
    def end(self) -> int:
        """The end's output."""
        return int(self.single[np.searchsorted(self.keys, END)])

    @cached_property
    def leads(self) -> np.ndarray:
        """The first place of a key with each of the highest 17 bits."""
        return np.searchsorted(self.keys, np.arange(-(1 << 16), 1 << 16) << 47)

    def places(self, h: np.ndarray) -> np.ndarray:
        """The places of the first keys that aren't smaller, or the last: keys are hashes, so few share their highest bits."""
        last = max(0, len(self.keys) - 1)
        at = np.minimum(self.leads[(h >> 47) + (1 << 16)], last)
        left = np.flatnonzero(self.keys[at] < h) if len(self.keys) else []
        while len(left):
            at[left] += 1
            left = left[at[left] <= last]
            left = left[self.keys[at[left]] < h[left]]
        return np.minimum(at, last)

    def look_up(self, h: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(input, count) of words: inputs are outputs first, then suffix classes; count is -1 for words outside the head."""
        at = self.places(h)
        known = self.keys[at] == h if len(self.keys) else np.zeros(len(h), bool)
        single = np.where(known, self.single[at], -1) if len(self.keys) else np.full(len(h), -1)
        return np.where(single >= 0, single, self.settings.n_single + suffix), np.where(known, self.counts[at], -1) if len(self.keys) else np.full(len(h), -1)


def build_vocabulary(counts: DataFrame, settings: Settings) -> tuple[Vocabulary, int]:
    """The vocabulary for broadcast, of bounded size, and the bin from which on words are in the head."""
    bins = {r["bin"]: r["k"] for r in counts.groupBy(bin_of(F.col("n")).alias("bin")).agg(F.count("*").alias("k")).collect()}  # a few hundred rows
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    room, least = settings.head_words, 1 << 30
    for b in sorted(bins, reverse=True):
        if bins[b] > room:
            break
        room, least = room - bins[b], b
    head = counts.where((bin_of(F.col("n")) >= least) | (F.col("h") == END)).toPandas().sort_values(["n", "h"], ascending=[False, True])
    # the end has an output in any case
    first = np.r_[np.flatnonzero(head["h"].to_numpy() == END), np.flatnonzero(head["h"].to_numpy() != END)][: settings.n_single]
    single = np.full(len(head), -1)
    single[np.sort(first)] = np.arange(len(first))
    head["single"] = single
    rest = counts.where(F.col("s") >= 0).groupBy("s").agg(F.sum(F.col("n") + 1).alias("z")).collect()
    z = np.ones(settings.n_suffix)
    for r in rest:
        z[r["s"]] += r["z"]
    own = head[(head["single"] >= 0) & (head["s"] >= 0)]
    np.subtract.at(z, own["s"].to_numpy(), own["n"].to_numpy() + 1)
    head = head.sort_values("h")
    v = Vocabulary(head["h"].to_numpy(), head["n"].to_numpy(), head["single"].to_numpy(), head["s"].to_numpy(), z, int(total["n"] or 0), int(total["v"]), settings)
    word = np.full(settings.n_single, 1e-9)
    word[v.single[v.single >= 0]] = v.counts[v.single >= 0] + 1.0
    word = word.reshape(settings.n_classes, settings.per_class)
    of_class = np.concatenate([word.sum(1), z])
    v.start_class = np.log(of_class / of_class.sum()).astype(np.float32)
    v.start_word = np.log(word / word.sum(1, keepdims=True)).astype(np.float32)
    return v, least


def fresh_weights(v: Vocabulary) -> dict[str, np.ndarray]:
    """Small random weights; the biases of the outputs give the tokens' shares."""
    s = v.settings
    draw = np.random.Generator(np.random.PCG64(s.seed))
    some = lambda *shape: (draw.standard_normal(shape) * 0.15).astype(np.float32)
    return {
        "E": some(s.n_single + s.n_suffix, 3 * s.hidden), "U": some(s.hidden, 3 * s.hidden), "Wc": some(s.hidden, s.n_classes + s.n_suffix) * 0.1, "bc": v.start_class.copy(),
        "Ww": some(s.n_classes, s.hidden, s.per_class) * 0.1, "bw": v.start_word.copy(),
    }


def sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)); `x` is used up."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Room:
    """Arrays by name that are used again and again, as memory that is freed and taken anew for each window has to be mapped anew."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}
        self.shown: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple[int, ...] | None = None, kind: np.dtype | None = None) -> np.ndarray:
        """An array of this shape with any contents; without a shape, the one that was last given out."""
        if shape is not None:
            size = int(np.prod(shape))
            if name not in self.held or len(self.held[name]) < size or self.held[name].dtype != kind:
                self.held[name] = np.empty(size, kind)
            self.shown[name] = self.held[name][:size].reshape(shape)
        return self.shown[name]


def by_gate(p: dict, x: np.ndarray, out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The inputs' part of each gate, (3, inputs, hidden), and the state's weights, (3, hidden, hidden): numpy then works along whole arrays."""
    n = len(p["U"])
    rows = 3 * x.astype(np.intp) + np.arange(3)[:, None]
    return np.take(p["E"].reshape(-1, n), rows, axis=0, out=out, mode="clip"), p["U"].reshape(n, 3, n).transpose(1, 0, 2).copy()


def unit(a: np.ndarray, h: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of the gated unit: the next state, and the state's part of the new one; `a`, the inputs' part, becomes (z, r, new)."""
    own = h @ u
    gates, new = a[:2], a[2]
    gates += own[:2]
    sigmoid(gates)
    new += a[1] * own[2]
    np.tanh(new, out=new)
    out = h - new
    out *= a[0]
    out += new
    return out, own[2]


def step(p: dict, h: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of the gated unit: the next state, and what its gradient needs."""
    a, u = by_gate(p, x)
    out, own = unit(a, h, u)
    return out, *a, own


def with_bias(w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weights with the biases as their last row: the weights of a one after the state."""
    return np.concatenate([w, b[..., None, :]], -2)


def with_one(states: np.ndarray) -> np.ndarray:
    """States with a one after each."""
    out = np.ones((len(states), states.shape[1] + 1), states.dtype)
    out[:, :-1] = states
    return out


def bounded(w: np.ndarray, states: np.ndarray) -> bool:
    """Whether exponentials of states @ w and their sums certainly fit 32 bits; states within -1 and 1 are the rule, then only large weights don't."""
    return bool(np.abs(w).sum(-2).max() * max(1.0, states.max(), -states.min()) <= SAFE)


def class_outputs(p: dict, states: np.ndarray, target: np.ndarray, s: Settings, room: Room) -> Iterator[tuple]:
    """Outputs over all classes, for PART states at a time: (their range, states @ w, a column for each, where their targets' are in it).

    A column for each state lets numpy add whole rows; each is less its largest value where exponentials might overflow.
    """
    w = with_bias(p["Wc"], p["bc"])
    turned, safe, width = w.T.copy(), bounded(w, states), min(PART, len(states))
    x = room("outputs", (len(turned), width), w.dtype)
    at = class_of(target, s) * width + np.arange(len(states)) % width
    for i in range(0, len(states), width):
        part = slice(i, min(i + width, len(states)))
        own = np.matmul(turned, states[part].T, out=x[:, : part.stop - i])
        if not safe:
            own -= own.max(0)
        yield part, own, at[part]


def token_outputs(p: dict, states: np.ndarray, target: np.ndarray, s: Settings, room: Room) -> tuple:
    """Outputs within the targets' classes, for targets with an output of their own: (these, by class; their states; (class, range) of each; a column for each; where its target's is)."""
    single = np.flatnonzero(target < s.n_single)
    of = target[single] // s.per_class
    single = single[np.argsort(of.astype(np.uint16), kind="stable")]  # numpy sorts short integers in linear time
    edge = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=s.n_classes))]).tolist()
    ranges = [(c, slice(edge[c], edge[c + 1])) for c in range(s.n_classes) if edge[c + 1] > edge[c]]
    w = with_bias(p["Ww"], p["bw"])
    some = np.take(states, single, axis=0)
    turned, x = w.transpose(0, 2, 1).copy(), room("within", (s.per_class, len(single)), w.dtype)
    for c, own in ranges:
        np.matmul(turned[c], some[own].T, out=x[:, own])
    if len(single) and not bounded(w, some):
        x -= x.max(0)
    return single, some, ranges, x, target[single] % s.per_class * len(single) + np.arange(len(single))


def class_of(target: np.ndarray, s: Settings) -> np.ndarray:
    return np.where(target < s.n_single, target // s.per_class, target - s.n_single + s.n_classes)


def log_likelihood(p: dict, states: np.ndarray, target: np.ndarray, s: Settings) -> np.ndarray:
    """ln P of each target's class and, for tokens with an output, of the token in its class."""
    out, room = np.empty(len(target), np.result_type(p["Wc"], states)), Room()
    for first in range(0, len(target), BLOCK):
        own, some, y = out[first : first + BLOCK], with_one(states[first : first + BLOCK]), target[first : first + BLOCK].astype(np.intp)
        for part, x, at in class_outputs(p, some, y, s, room):
            own[part] = room("outputs").take(at)
            own[part] -= np.log(np.exp(x, out=x).sum(0))
        single, _, _, x, at = token_outputs(p, some, y, s, room)
        value = x.take(at)
        own[single] += value - np.log(np.exp(x, out=x).sum(0))
    return out


def less_softmax(x: np.ndarray, weight: np.ndarray, flat: np.ndarray, at: np.ndarray) -> None:
    """Makes of each column its softmax less 1 at its place `at` of `flat`, which x lies in, times its weight."""
    np.exp(x, out=x)
    x *= weight / x.sum(0)
    flat[at] -= weight


def gradients(p: dict, h: np.ndarray, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, live: np.ndarray, s: Settings, room: Room | None = None) -> tuple[dict, np.ndarray]:
    """Truncated backpropagation over a window: x, y, fresh (a text begins), live are (steps, lanes); h is the state before."""
    steps, lanes = x.shape
    n, kind, size = s.hidden, p["U"].dtype, x.size
    room = Room() if room is None else room
    a, u = by_gate(p, x.ravel(), room("gates", (3, size, n), kind))
    a = a.reshape(3, steps, lanes, n)
    states, kept = room("states", (steps, lanes, n + 1), kind), []
    states[:, :, n] = 1
    begins, stay = fresh.any(1).tolist(), (~fresh)[:, :, None].astype(kind)
    for t in range(steps):
        if begins[t]:
            h = h * stay[t]
        old = h
        h, own = unit(a[:, t], h, u)
        kept.append((old, own))
        states[t, :, :n] = h
    flat, target, use = states.reshape(-1, n + 1), y.ravel().astype(np.intp), live.ravel().astype(kind)
    g, dh, dc, back = {}, room("dh", (size, n), kind), 0, p["Wc"].T.copy()
    for part, d, at in class_outputs(p, flat, target, s, room):
        less_softmax(d, use[part], room("outputs").reshape(-1), at)
        dc = dc + d @ flat[part]
        np.matmul(d.T, back, out=dh[part])
    g["Wc"], g["bc"] = dc[:, :-1].T, dc[:, -1]
    g["Ww"], g["bw"] = np.zeros_like(p["Ww"]), np.zeros_like(p["bw"])
    single, some, ranges, d, at = token_outputs(p, flat, target, s, room)
    less_softmax(d, use[single], d.reshape(-1), at)
    more, back = np.empty((len(single), n), kind), p["Ww"].transpose(0, 2, 1).copy()
    for c, own in ranges:
        dc = d[:, own] @ some[own]
        g["Ww"][c], g["bw"][c] = dc[:, :-1].T, dc[:, -1]
        np.matmul(d[:, own].T, back[c], out=more[own])
    dh[single] += more
    dh = dh.reshape(steps, lanes, n)
    # by the gates' arguments: of (z, r, new), and of what the state adds to the new part; a row of zeros follows
    rows, of_state, olds = room("rows", (size + 1, 3 * n), kind), room("of_state", (steps, lanes, n), kind), room("olds", (steps, lanes, n), kind)
    rows[-1] = 0
    da = rows[:-1].reshape(steps, lanes, 3 * n)
    carry, turned = np.zeros((lanes, n), kind), p["U"].T.copy()
    for t in range(steps - 1, -1, -1):
        (z, r, new), (old, own), d, back = a[:, t], kept[t], dh[t], of_state[t]
        olds[t] = old
        d += carry
        stays = d * z
        d -= stays
        old = old - new
        old *= z
        np.multiply(old, d, out=da[t, :, :n])
        new *= new
        new *= d
        d -= new
        da[t, :, 2 * n :] = d
        np.multiply(d, r, out=back)
        np.subtract(1, r, out=r)
        r *= own
        np.multiply(r, back, out=da[t, :, n : 2 * n])
        carry = da[t, :, : 2 * n] @ turned[: 2 * n]
        carry += back @ turned[2 * n :]
        carry += stays
        if begins[t]:
            carry *= stay[t]
    olds = olds.reshape(-1, n).T
    g["U"] = np.concatenate([olds @ rows[:-1, : 2 * n], olds @ of_state.reshape(-1, n)], 1)
    g["E"] = sums_by_input(rows, x.ravel(), len(p["E"]), room)
    scale = 1 / max(1.0, float(use.sum()))
    norm = np.sqrt(sum(float(np.vdot(x, x)) for x in g.values())) * scale
    scale *= min(1.0, 1.0 / max(norm, 1e-9))
    for d in g.values():
        d *= float(scale)
    return g, h


def sums_by_input(rows: np.ndarray, x: np.ndarray, n: int, room: Room) -> np.ndarray:
    """The sums of the rows of each of n inputs; x: the rows' inputs; one row of zeros follows them.

    Rows are summed by eight, then the sums: numpy is slow where runs of rows are short.
    """
    count = np.bincount(x, minlength=n)
    used = -(-count // 8)
    first = np.cumsum(used) - used
    where = np.full(8 * int(used.sum()), len(x))
    where[np.arange(len(x)) + np.repeat(8 * first - (np.cumsum(count) - count), count)] = np.argsort(x.astype(np.uint16), kind="stable")
    some = np.take(rows, where, axis=0, out=room("eights", (len(where), rows.shape[1]), rows.dtype), mode="clip")
    some = (np.ones((1, 8), rows.dtype) @ some.reshape(-1, 8, rows.shape[1]))[:, 0]
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    out[used > 0] = np.add.reduceat(some, first[used > 0])
    return out


class Trainer:
    """Adam over windows of a stream of tokens dealt to lanes; states are carried from window to window."""

    def __init__(self, p: dict, s: Settings, rate: float):
        self.p, self.s, self.rate, self.time, self.tokens = {k: x.copy() for k, x in p.items()}, s, rate, 0, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def train(self, tokens: np.ndarray, begin: np.ndarray, end: int) -> None:
        """Learn from texts one after the other; begin: where they start. Each text's tokens end with `end`."""
        s, n = self.s, len(tokens)
        lanes = int(np.clip(n // (s.window * 60), 4, s.lanes))
        length = -(-n // lanes)
        size = -(-length // s.window) * s.window
        x = np.full(n, end)
        x[1:] = tokens[:-1]
        x[begin] = end
        fresh = np.zeros(n, bool)
        fresh[begin] = True

        def dealt(values, rest, kind):
            """A column for each lane, filled up with `rest`."""
            out = np.full(lanes * length, rest, kind)
            out[:n] = values
            return np.concatenate([out.reshape(lanes, length).T, np.full((size - length, lanes), rest, kind)])

        y, inputs, first, live = dealt(tokens, end, np.uint16), dealt(x, end, np.uint16), dealt(fresh, False, bool), dealt(np.ones(n, bool), False, bool)
        first[0] = True
        h, room = np.zeros((lanes, s.hidden), np.float32), Room()
        for t in range(0, size, s.window):
            span = slice(t, t + s.window)
            g, h = gradients(self.p, h, inputs[span], y[span], first[span], live[span], s, room)
            self.time += 1
            rate = self.rate * min(1.0, self.time / 10) * np.sqrt(1 - 0.99**self.time) / (1 - 0.9**self.time)
            for k, d in g.items():
                m, v = self.m[k], self.v[k]
                m += 0.1 * (d - m)
                np.multiply(d, d, out=d)
                d -= v
                d *= 0.01
                v += d
                np.sqrt(v, out=d)
                d += 1e-6
                np.divide(m, d, out=d)
                d *= float(rate)
                self.p[k] -= d
        self.tokens += n


def score_texts(p: dict, tokens: np.ndarray, begin: np.ndarray, end: int, s: Settings) -> np.ndarray:
    """ln P of each token, the texts' states carried from their first token to their last, whatever their length.

    Texts are dealt to lanes, longest first; all lanes step together and a lane that is done drops out. A window's
    outputs are worked out at once.
    """
    n = len(tokens)
    out = np.zeros(n)
    if not n:
        return out
    x = np.full(n, end)
    x[1:] = tokens[:-1]
    x[begin] = end
    size = np.diff(begin, append=n)
    lanes = int(np.clip(n // 2000, 1, 2 * s.lanes))
    # consecutive shares of the texts by falling length, of about equal size
    order = np.argsort(-size, kind="stable")
    load = np.zeros(lanes, np.int64)
    lane, place = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
    heap = [(0, i) for i in range(lanes)]
    for i in order.tolist():
        used, k = heap[0]
        lane[i], place[i] = k, used
        heapq.heapreplace(heap, (used + int(size[i]), k))
        load[k] = used + size[i]
    by_load = np.argsort(-load, kind="stable")
    rank = np.empty(lanes, np.int64)
    rank[by_load] = np.arange(lanes)
    load = load[by_load]
    row = (np.repeat(place - begin, size) + np.arange(n)).astype(np.int32)
    # tokens by step, then lane: step t holds the lanes with load > t, a prefix
    edge = np.concatenate([[0], np.cumsum(np.searchsorted(-load, -np.arange(1, int(load[0]) + 1), "right"))])
    to = edge[row] + np.repeat(rank[lane], size)
    begins = np.zeros(len(edge), bool)
    begins[place] = True
    where = np.empty(n, np.int32)
    where[to] = np.arange(n, dtype=np.int32)
    del row, to
    fresh = np.zeros(n, bool)
    fresh[begin] = True
    x, y, fresh = x[where], tokens[where], fresh[where]
    h, edge, begins = np.zeros((lanes, s.hidden), np.float32), edge.tolist(), begins.tolist()
    t = 0
    while t < len(edge) - 1:
        # some steps at once
        last = min(max(t + 1, bisect.bisect_right(edge, edge[t] + 2 * BLOCK) - 1), len(edge) - 1)
        first, until = edge[t], edge[last]
        a, u = by_gate(p, x[first:until])
        states = np.empty((until - first, s.hidden), np.float32)
        while t < last:
            own = slice(edge[t] - first, edge[t + 1] - first)
            h = h[: own.stop - own.start]
            if begins[t]:
                h = h * ~fresh[edge[t] : edge[t + 1], None]
            h = states[own] = unit(a[:, own], h, u)[0]
            t += 1
        out[where[first:until]] = log_likelihood(p, states, y[first:until], s)
    return out


# -- Spark jobs --------------------------------------------------------------------------------------------------


def token_stream(data: np.ndarray, at: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, T.Words, np.ndarray]:
    """(tokens with ends, each text's first, counts of the words, words, keys of the words) of a slice."""
    w = T.Words(data, at)
    h = T.signed(w.hashes(lower=True))
    inputs, counts = v.look_up(h, suffix_class(w, v.settings.n_suffix))
    begin = w.first + np.arange(len(w.first))
    tokens = np.full(len(h) + len(begin), v.end)
    tokens[np.arange(len(h)) + w.text] = inputs
    return tokens, begin, counts, w, h


def average(rows: pd.DataFrame) -> tuple[dict, int]:
    """Weights averaged by tokens."""
    total, out = int(rows["tokens"].sum()), {}
    for tokens, blob in zip(rows["tokens"], rows["weights"], strict=True):
        for k, x in pickle.loads(blob).items():
            out[k] = out.get(k, 0) + x.astype(np.float64) * (tokens / total)
    return {k: x.astype(np.float32) for k, x in out.items()}, total


def streams(batches: Iterator[pa.RecordBatch], most: int = 1_500_000) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Batches with a column tokens gathered to about `most` tokens: (batches, tokens, each text's first)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index("tokens"))
        bytes_of = pc.binary_length(column).to_numpy()
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, first + int(np.searchsorted(np.cumsum(bytes_of[first:]), 2 * (most - size), "right")))
            held.append(batch.slice(first, last - first))
            size += int(bytes_of[first:last].sum()) // 2
            first = last
            if size >= most:
                yield joined(held)
                held, size = [], 0
    if held:
        yield joined(held)


def joined(held: list[pa.RecordBatch]) -> tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]:
    texts = [x for batch in held for x in batch.column(batch.schema.get_field_index("tokens")).to_pylist()]
    size = np.array([len(x) // 2 for x in texts])
    return held, np.frombuffer(b"".join(texts), "<u2").astype(np.int64), np.cumsum(size) - size


def train(texts: DataFrame, key: str, v: Vocabulary) -> dict[str, np.ndarray]:
    """Weights after all rounds on (key, tokens) per text; the value of `key` deals texts to rounds, in proportion to settings.rounds."""
    s, end = v.settings, v.end
    context = texts.sparkSession.sparkContext
    p, shares = fresh_weights(v), np.concatenate([[0], np.cumsum(s.rounds)])
    deal = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(int(shares[-1])))
    for k in range(len(s.rounds)):
        start = context.broadcast(p)

        def run(batches, start=start, k=k):
            trainer = Trainer(start.value, s, s.rate / (1 + k))
            for _, tokens, begin in streams(batches):
                trainer.train(tokens, begin, end)
            if trainer.tokens:
                yield pa.RecordBatch.from_arrays([pa.array([trainer.tokens]), pa.array([pickle.dumps(trainer.p)])], ["tokens", "weights"])

        def merge(rows: pd.DataFrame) -> pd.DataFrame:
            p, total = average(rows)
            return pd.DataFrame({"tokens": [total], "weights": [pickle.dumps(p)]})

        made = cut(texts.where((deal >= int(shares[k])) & (deal < int(shares[k + 1]))).select("tokens").mapInArrow(run, "tokens long, weights binary").withColumn("part", F.spark_partition_id()))
        while (n := made.count()) > s.fan_in:
            groups = -(-n // s.fan_in)
            made = cut(made.groupBy(F.pmod("part", F.lit(groups)).alias("g")).applyInPandas(lambda rows: merge(rows), "tokens long, weights binary").withColumn("part", F.spark_partition_id()))
        rows = made.select("tokens", "weights").toPandas()  # at most fan_in rows
        if len(rows):
            p = average(rows)[0]
    return p


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_of: int = 7, held_out_is: int = 2, settings: Settings = Settings()) -> DataFrame:
    """Per row of `docs`: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability).

    Rows with crc32(id as text) mod `held_out_of` = `held_out_is` are held out of training; a null id counts as ''. A null text is
    empty and has just its end; a text may have any length. An empty table gives an empty result. If nothing is left to train on, every word is unknown and both scores are those of an
    empty vocabulary. Rows with the same id are scored one by one. Other columns of `docs` play no part.
    """
    bounded_batches(docs.sparkSession)
    s = settings
    part = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(held_out_of)) == held_out_is
    rows = docs.select(F.col(id_col).alias("id"), part.alias("held_out"), F.col(text_col).alias("text"))
    texts = rows.where(~F.col("held_out")).select(F.coalesce("id", F.lit(0)).alias("key"), "text")
    counts = cut(word_counts(texts, s.n_suffix))
    v, least = build_vocabulary(counts, s)
    if v.tokens == 0:
        v.keys, v.counts, v.single, v.suffix = np.array([END]), np.array([0]), np.array([0]), np.array([-1])
    context = docs.sparkSession.sparkContext
    words = context.broadcast(v)
    rest, of_end = np.log10(v.rest), float(np.log10(v.counts[np.searchsorted(v.keys, END)] + 1.0))

    def look_up(batches):
        v = words.value
        for some, data, at in T.slices(batches):
            tok, begin, counts, w, h = token_stream(data, at, v)
            texts = len(begin)
            inputs = tok[np.arange(len(h)) + w.text]
            other, tail = inputs >= s.n_single, counts < 0
            log_count = np.log10(np.maximum(counts, 0) + 1.0)
            share = np.where(other, log_count - rest[np.where(other, inputs - s.n_single, 0)], 0.0)
            base = np.bincount(w.text, np.where(tail, 0.0, log_count), texts) + of_end
            known = np.bincount(w.text[~tail], minlength=texts) + int(v.tokens > 0)
            key = np.stack([w.text[tail], h[tail]], 1)
            order = np.lexsort((key[:, 1], key[:, 0]))
            key = key[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]).any(1)
            at = np.flatnonzero(new)
            per = np.bincount(key[at, 0], minlength=texts)
            edge = (2 * np.append(begin, len(tok))).tolist()
            ids = tok.astype("<u2").tobytes()
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array(w.count + 1, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(np.bincount(w.text, share, texts).astype(np.float64), pa.float64()), pa.array([ids[a:b] for a, b in zip(edge, edge[1:])], pa.binary()), T.lists(key[at, 1], per), T.lists(np.diff(at, append=len(key)), per)],  # noqa: B905
                ["id", "held_out", "n_tokens", "n_known", "base", "share", "tokens", "tail", "times"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    # the network reads token ids from here on, not texts
    made = rows.mapInArrow(look_up, f"id {kind}, held_out boolean, n_tokens long, n_known long, base double, share double, tokens binary, tail array<long>, times array<long>")
    made = cut(made.withColumn("row_id", F.monotonically_increasing_id()))
    p = train(made.where(~F.col("held_out")).select(F.coalesce("id", F.lit(0)).alias("key"), "tokens"), "key", v) if v.tokens else fresh_weights(v)
    weights, end = context.broadcast(p), v.end

    def run(batches):
        for held, tokens, begin in streams(batches, SCORED):
            ln = score_texts(weights.value, tokens, begin, end, s) / np.log(10)
            text = np.repeat(np.arange(len(begin)), np.diff(begin, append=len(tokens)))
            score = np.bincount(text, ln, len(begin))
            done = 0
            for batch in held:
                own = score[done : done + batch.num_rows]
                done += batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(own + batch.column(batch.num_columns - 1).to_numpy(), pa.float64())], [*batch.schema.names[:-2], "score"])

    facts = ["row_id", "id", "held_out", "n_tokens", "n_known", "base"]
    scored = made.select(*facts, "tokens", "share").mapInArrow(run, f"row_id long, id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double")
    # words outside the head: their counts come by a join, once per text and word
    tail = made.select("row_id", F.explode(F.arrays_zip("tail", "times")).alias("x")).select("row_id", F.col("x.tail").alias("h"), F.col("x.times").alias("times"))
    rare = counts.where((bin_of(F.col("n")) < least) & (F.col("h") != END)).select("h", "n")
    found = tail.join(rare, "h").groupBy("row_id").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("times").alias("met"))
    size = float(np.log10(v.tokens + v.types + 1.0))
    more, met = F.coalesce("more", F.lit(0.0)), F.coalesce("met", F.lit(0))
    return scored.join(found, "row_id", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + met).alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(size)).alias("base_score"), (F.col("score") + more).alias("score"),
    )
