"""Repeated passages by an enhanced suffix array: every byte that lies in a string of `least` bytes found at two places.

Each window of `least` bytes has an anchor, the last of its k-grams of least hash, so equal windows have equal anchors at
equal places. Neighbouring windows with one anchor are a run; a run's context is the text under its windows. Runs with
anchors of their own have no repeats. Runs with equal contexts repeat in full, found by counting hashes. The remaining contexts of
an anchor form a class. Sorted by what follows the anchor they are a sparse suffix array; a stack scan of its common
prefixes gives the intervals of the prefix tree, and in each interval the order of the reversed left sides gives every
member's longest left extension, so that all members' maximal repeats come out, not only neighbours'.
Texts are named by their MD5, so copies of a text are one text, and a text with copies repeats in full.

Passages of so many words are found apart: windows of words whose anchor, chosen as above, is found at two places are counted by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidara.llm import textkit as T
from evidara.session import bounded_batches, cut, drop, likely, marked

GRAM = 32
#: Words of an anchor where passages are counted in words.
WORD_GRAM = 20
#: Windows of a text that are worked on at once.
WINDOWS = 1 << 20
#: Contexts of a class that one task takes at once; larger classes are counted window by window.
CLASS = 4096
#: Bytes of a text whose ranges are sorted together.
BLOCK = 1 << 16
_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd constant and of its inverse modulo 2**64, in bytes' order."""
    if len(_tables.get("up", ())) < n:
        step = 0x9E3779B97F4A7C15
        size = max(n, 1 << 16)
        for name, base in (("up", step), ("down", pow(step, -1, 1 << 64))):
            _tables[name] = np.concatenate([[T.U(1)], np.cumprod(np.full(size - 1, base, T.U))])
    return _tables["up"], _tables["down"]


class Prefix:
    """Hashes of all substrings of a byte array."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sum = np.zeros(len(data) + 1, T.U)
        np.cumsum((T.LINE_TABLE + T.U(1))[data] * up[: len(data)], out=self.sum[1:])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of data[first:last]."""
        return T.mix((self.sum[last] - self.sum[first]) * self.down[first] + (last - first).astype(T.U))


def least_places(h: np.ndarray, span: int, windows: int) -> np.ndarray:
    """The place of the last least hash among the `span` hashes from each window's start.

    A window is the end of one block of `span` hashes and the beginning of the next; minima and their last places are carried along
    each block from both sides.
    """
    n = -(-len(h) // span) * span
    padded = np.full(n, np.iinfo(T.U).max, T.U)
    padded[: len(h)] = h
    square, place = padded.reshape(-1, span), np.arange(n).reshape(-1, span)
    ahead = np.minimum.accumulate(square, 1)
    ahead_at = np.maximum.accumulate(np.where(square == ahead, place, 0), 1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], 1)[:, ::-1]
    better = np.ones(square.shape, bool)
    better[:, :-1] = square[:, :-1] < behind[:, 1:]
    behind_at = np.minimum.accumulate(np.where(better, place, n)[:, ::-1], 1)[:, ::-1].ravel()
    ahead, behind = ahead.ravel(), behind.ravel()
    own, next_end = slice(0, windows), slice(span - 1, span - 1 + windows)
    return np.where(ahead[next_end] <= behind[own], ahead_at[next_end], behind_at[own])


def neighbours(anchor: np.ndarray, text: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last window of each run of windows with one anchor that lie inside one text."""
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    lo = np.flatnonzero(new & inside)
    edge = np.flatnonzero(new | ~inside)
    after = np.searchsorted(edge, lo, "right")
    return lo, (np.where(after < len(edge), edge[np.minimum(after, len(edge) - 1)], len(anchor)) - 1 if len(lo) else lo)


def runs(data: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(text, lo, hi, anchor place, anchor hash, context hash) of the runs of all texts; places count from the slice's start."""
    span = least - GRAM + 1
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, T.U),) * 2
    if len(data) < least:
        return none
    prefix = Prefix(data)
    grams = len(data) - GRAM + 1
    place = np.arange(grams)
    windows = len(data) - least + 1
    anchor = least_places(prefix.of(place, place + GRAM), span, windows)
    text = np.searchsorted(at, np.arange(windows), "right") - 1
    inside = np.arange(windows) + least <= at[text + 1]
    lo, hi = neighbours(anchor, text, inside)
    if not len(lo):
        return none
    return text[lo], lo, hi, anchor[lo], prefix.of(anchor[lo], anchor[lo] + GRAM), prefix.of(lo, hi + least)


def run_rows(texts: DataFrame, least: int) -> DataFrame:
    """(key, size, anchor, context, left, lo, n) per row of (key, text): lists of the text's runs; lo is a byte, n windows.

    A long text's windows are taken in parts of WINDOWS; a run at the edge of a part is two runs.
    """

    def parts(data, at):
        if len(data) <= 2 * WINDOWS:
            yield 0, data, at
        else:
            for first in range(0, max(1, len(data) - least + 1), WINDOWS):
                part = data[first : first + WINDOWS + least - 1]
                yield first, part, np.array([0, len(part)])

    def run(batches):
        for rows, data, at in T.slices(batches, most=WINDOWS):
            found = []
            for first, part, offsets in parts(data, at):
                text, lo, hi, place, anchor, context = runs(part, offsets, least)
                found.append((text, lo + first, hi + first, place + first, anchor, context))
            text, lo, hi, place, anchor, context = (np.concatenate(x) for x in zip(*found, strict=True))
            per = np.bincount(text, minlength=rows.num_rows)
            columns = [T.signed(anchor), T.signed(context), (place - lo).astype(np.int32), (lo - at[text]).astype(np.int32), (hi - lo + 1).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(at)), *(T.lists(c, per) for c in columns)], ["key", "size", "anchor", "context", "left", "lo", "n"])

    return texts.mapInArrow(T.tidied(run), "key binary, size long, anchor array<long>, context array<long>, left array<int>, lo array<int>, n array<int>")


def common(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every interval of suffixes with a common prefix, children before parents; lcp[i]: of suffixes i and i + 1."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


class Least:
    """Minima of ranges."""

    def __init__(self, values: list[int]):
        self.rows = [np.array(values, np.int64)]
        while len(self.rows[-1]) > 1 << len(self.rows) - 1 and len(self.rows[-1]) - (1 << len(self.rows) - 1) > 0:
            half = 1 << len(self.rows) - 1
            self.rows.append(np.minimum(self.rows[-1][:-half], self.rows[-1][half:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """min(values[first:last]) for first < last."""
        level = np.frompyfunc(lambda n: n.bit_length() - 1, 1, 1)((last - first).astype(object)).astype(np.int64)
        out = np.empty(len(first), np.int64)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.rows[k][first[own]], self.rows[k][last[own] - (1 << int(k))])
        return out


def maximal_repeats(contexts: list[bytes], left: list[int], least: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """(depth, members, extensions) for each interval of the class: each member's repeat reaches `extension` bytes to the left and `depth` to the right of
    the anchor, and no other member of the interval shares more on its left."""
    right = [c[k:] for c, k in zip(contexts, left, strict=True)]
    turned = [c[:k][::-1] for c, k in zip(contexts, left, strict=True)]
    suffixes = sorted(range(len(right)), key=right.__getitem__)
    lcp = [common(right[a], right[b]) for a, b in zip(suffixes, suffixes[1:])]  # noqa: B905
    by_left = sorted(range(len(turned)), key=turned.__getitem__)
    shared = [common(turned[a], turned[b]) for a, b in zip(by_left, by_left[1:])]  # noqa: B905
    rank = [0] * len(by_left)
    for k, i in enumerate(by_left):
        rank[i] = k
    table = Least(shared) if len(shared) > 32 else None
    for depth, first, last in intervals(lcp):
        members = sorted(suffixes[first : last + 1], key=rank.__getitem__)
        places = [rank[i] for i in members]
        if table is None:
            between = [min(shared[a:b]) for a, b in zip(places, places[1:])]  # noqa: B905
        else:
            at = np.array(places)
            between = table.of(at[:-1], at[1:]).tolist()
        extensions = [max(a, b) for a, b in zip([0, *between], [*between, 0], strict=True)]
        if max(extensions) + depth >= least:
            yield depth, members, extensions


def covered(contexts: list[bytes], left: list[int], least: int) -> dict[int, list[tuple[int, int]]]:
    """For each context with repeats, the ranges [first, last) of its bytes that lie in repeats of `least` bytes or more."""
    out: dict[int, list[tuple[int, int]]] = {}
    for depth, members, extensions in maximal_repeats(contexts, left, least):
        for i, extension in zip(members, extensions, strict=True):
            if extension + depth >= least:
                found = (left[i] - extension, left[i] + depth)
                own = out.setdefault(i, [])
                if found not in own:
                    own.append(found)
    return out


def in_texts(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, text) of the texts whose key is in `keys` (distinct), each text once."""
    return likely(texts, keys, "key").join(keys, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))


def ranges_of_classes(contexts: DataFrame, least: int) -> DataFrame:
    """(key, first, last) from (anchor, left, key, lo, single, bytes), where no class has more than CLASS rows."""

    def judge(rows: list[tuple]) -> Iterator[tuple[bytes, int, int]]:
        found = covered([r[4] for r in rows], [r[0] for r in rows], least)
        for i, own in found.items():
            _, key, lo, single, _ = rows[i]
            if single:
                for first, last in own:
                    yield key, lo + first, lo + last

    def run(batches):
        held: list[tuple] = []
        now = None
        for batch in batches:
            out: list[tuple] = []
            anchors = batch.column(0).to_pylist()
            for anchor, *row in zip(anchors, *(batch.column(k).to_pylist() for k in range(1, 6)), strict=True):
                if anchor != now:
                    if len(held) > 1:
                        out += judge(held)
                    held, now = [], anchor
                held.append(tuple(row))
            yield record(out)
        if len(held) > 1:
            yield record(list(judge(held)))

    def record(out: list[tuple]) -> pa.RecordBatch:
        keys, first, last = zip(*out, strict=True) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(first, pa.int32()), pa.array(last, pa.int32())], ["key", "first", "last"])

    return contexts.repartition("anchor").sortWithinPartitions("anchor").select("anchor", "left", "key", "lo", "single", "bytes").mapInArrow(T.tidied(run), "key binary, first int, last int")


def ranges_of_windows(contexts: DataFrame, least: int) -> DataFrame:
    """The same for classes of any size: each window of a context is counted by its hash and its place before the anchor."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                data = np.frombuffer(batch.column(5)[row].as_py(), np.uint8)
                at = np.arange(len(data) - least + 1)
                left = batch.column(1)[row].as_py()
                h = T.signed(T.mix(Prefix(data).of(at, at + least) + (left - at).astype(T.U) + T.U(batch.column(0)[row].as_py() % (1 << 64))))
                n = len(at)
                yield pa.RecordBatch.from_arrays([batch.column(2).take(pa.array([row] * n)), batch.column(4).take(pa.array([row] * n)), pa.array((batch.column(3)[row].as_py() + at).astype(np.int32)), pa.array(h)], ["key", "single", "first", "h"])

    windows = cut(contexts.select("anchor", "left", "key", "lo", "single", "bytes").mapInArrow(T.tidied(run), "key binary, single boolean, first int, h long"))
    again = cut(windows.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"))
    return windows.where("single").join(again, "h", "left_semi").select("key", "first", (F.col("first") + least).alias("last"))


def repeated_ranges(docs: DataFrame, text_col: str = "text", least: int = 400) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, sizes, ranges): texts has (key, text) per row of `docs`, sizes (key, copies, size) per distinct text, and ranges (key,
    first, last) of repeated bytes of the texts without copies; ranges may overlap."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.unhex(F.md5(text)).alias("key"), text.alias("text"))
    made = run_rows(texts, least).groupBy("key").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("size", "anchor", "context", "left", "lo", "n")))
    made = cut(made)
    flat = made.select("key", "copies", F.explode(F.arrays_zip("anchor", "context", "left", "lo", "n")).alias("r")).select("key", (F.col("copies") > 1).alias("copied"), "r.*")
    # every count is combined in the tasks before it is dealt, and what is joined is a table, so that Spark can split a hot anchor
    shared = cut(flat.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"))
    flat = cut(likely(flat, shared, "anchor").join(shared, "anchor"))
    sizes = cut(made.select("key", "copies", "size"))
    drop(made)
    contexts = flat.groupBy("anchor", "context", "left").agg(F.count("*").alias("c"), F.max("copied").alias("copied"), F.min(F.struct("key", "lo", "n")).alias("r"))
    contexts = cut(contexts.select("anchor", "context", "left", "c", ((F.col("c") == 1) & ~F.col("copied")).alias("single"), "r.*"))
    # texts with copies are removed in full, so just the other texts' runs need a range
    again = cut(contexts.where("c > 1 OR NOT single").select("anchor", "context", "left"))
    whole = flat.where("NOT copied").join(again, ["anchor", "context", "left"])
    whole = cut(whole.select("key", F.col("lo").alias("first"), (F.col("lo") + F.col("n") - 1 + least).alias("last")))
    classes = cut(contexts.groupBy("anchor").agg(F.count("*").alias("d"), F.max("single").alias("open")).where("d > 1 AND open").select("anchor", "d"))
    open_contexts = cut(contexts.join(classes, "anchor").select("anchor", "left", "single", "key", "lo", "n", "d"))
    drop(shared, flat, contexts, again, classes)

    def extract(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for text, rows, key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(0).to_pylist(), strict=True):
                data = text.encode()
                for r in rows:
                    values = (r["anchor"], r["left"], key, r["lo"], r["single"], data[r["lo"] : r["lo"] + r["n"] - 1 + least], r["d"])
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.bool_(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["anchor", "left", "key", "lo", "single", "bytes", "d"])

    wanted = open_contexts.groupBy("key").agg(F.collect_list(F.struct("anchor", "left", "lo", "single", "n", "d")).alias("rows"))
    cuts = cut(in_texts(texts, open_contexts.select("key").distinct()).join(wanted, "key").select("key", "text", "rows").mapInArrow(T.tidied(extract), "anchor long, left int, key binary, lo int, single boolean, bytes binary, d long"))
    found = cut(ranges_of_classes(cuts.where(F.col("d") <= CLASS), least).union(ranges_of_windows(cuts.where(F.col("d") > CLASS), least)))
    drop(open_contexts, cuts)
    return texts, sizes, whole.union(found)


def word_run_rows(texts: DataFrame, words: int) -> DataFrame:
    """(key, size, anchor, lo, n) per row of (key, text): lists of the runs of windows of `words` words; lo is the text's word, n windows."""
    gram = min(WORD_GRAM, words)

    def run(batches):
        for rows, data, at in T.slices(batches):
            w = T.Words(data, at)
            h = w.hashes()
            windows = len(h) - words + 1
            anchor = lo = n = text = np.zeros(0, np.int64)
            if windows > 0:
                grams = w.windows(h, gram, across=True)[0]
                place = least_places(grams, words - gram + 1, windows)
                lo, hi = neighbours(place, w.text[:windows], w.text[:windows] == w.text[words - 1 :])
                anchor, n, text = T.signed(grams[place[lo]]), hi - lo + 1, w.text[lo]
                lo = lo - w.first[text]
            per = np.bincount(text, minlength=rows.num_rows)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(at)), *(T.lists(c, per) for c in (anchor, lo.astype(np.int32), n.astype(np.int32)))], ["key", "size", "anchor", "lo", "n"])

    return texts.mapInArrow(T.tidied(run), "key binary, size long, anchor array<long>, lo array<int>, n array<int>")


def repeated_words(texts: DataFrame, words: int, least: int) -> DataFrame:
    """(key, first, last) of the bytes of `texts` (key, text per row) that lie in `words` words found at two places, whatever is between words.

    Texts with copies repeat in full; those of `least` bytes or more, which repeat anyway, have no range.
    """
    made = cut(word_run_rows(texts, words).groupBy("key").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("size", "anchor", "lo", "n"))))
    flat = made.select("key", "copies", ((F.col("copies") == 1) | (F.col("size") < least)).alias("open"), F.explode(F.arrays_zip("anchor", "lo", "n")).alias("r")).select("key", "copies", "open", "r.*")
    shared = cut(flat.groupBy("anchor").agg(F.sum("copies").alias("c")).where("c > 1").select("anchor"))
    wanted = cut(likely(flat, shared, "anchor").join(shared, "anchor", "left_semi").groupBy("key", "copies", "open").agg(F.collect_list(F.struct("lo", "n")).alias("rows")))
    drop(made, shared)

    def run(batches):
        for part, data, at in T.slices(batches):
            w = T.Words(data, at)
            h, first = w.windows(w.hashes(), words)
            rows = part.column(3).combine_chunks() if isinstance(part.column(3), pa.ChunkedArray) else part.column(3)
            per = np.diff(rows.offsets.to_numpy())
            lo, n = (rows.flatten().field(k).to_numpy().astype(np.int64) for k in range(2))
            own = np.repeat(np.arange(part.num_rows), per)
            start = np.repeat(w.first[own] + lo, n)
            start += np.arange(len(start)) - np.repeat(np.cumsum(n) - n, n)
            text = np.repeat(own, n)
            begins, ends = w.start[start] - at[text], w.end[start + words - 1] - at[text]
            copies = part.column(4).to_numpy()[text]
            begins[(copies > 1) & (start == w.first[text])] = 0
            whole = (copies > 1) & (start + words == w.last[text])
            ends[whole] = np.diff(at)[text[whole]]
            take = pa.array(text)
            yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(2).take(take), pa.array(copies), pa.array(begins.astype(np.int32)), pa.array(ends.astype(np.int32)), pa.array(T.signed(h[np.searchsorted(first, start)]))], ["key", "open", "copies", "first", "last", "h"])

    found = in_texts(texts, wanted.select("key")).join(wanted, "key").select("key", "text", "open", "rows", "copies")
    windows = cut(found.mapInArrow(T.tidied(run), "key binary, open boolean, copies long, first int, last int, h long"))
    again = cut(windows.groupBy("h").agg(F.sum("copies").alias("c")).where("c > 1").select("h"))
    drop(wanted)
    found = cut(likely(windows.where("open"), again, "h").join(again, "h", "left_semi").select("key", "first", "last"))
    drop(windows, again)
    return found


def joined_up(ranges: DataFrame) -> DataFrame:
    """Ranges (key, first, last, gone) with those that touch made one, in blocks of BLOCK bytes of a text.

    Ranges are sorted by Spark and never gathered, so a text may have any number of them; what is left has a few ranges a block.
    """
    own = Window.partitionBy("key", "gone", "block").orderBy("first", "last")
    reach = F.max("last").over(own.rowsBetween(Window.unboundedPreceding, -1))
    made = ranges.withColumn("block", F.floor(F.col("first") / BLOCK)).withColumn("new", F.coalesce((F.col("first") > reach).cast("int"), F.lit(1)))
    made = made.withColumn("run", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return made.groupBy("key", "gone", "block", "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).select("key", "first", "last", "gone")


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the ranges cover; ranges that touch are one run."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 400, with_text: bool = False, keep: list[str] | None = None, words: int | None = None, cut_words: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_bytes, the columns `keep`, and with `with_text` the remaining text) per row of `docs`.

    Every byte in a string of `least` bytes that also starts anywhere else, in its own text or another's, is removed; with `words` and `cut_words`,
    so is every run of so many words that is found at two places, whatever its bytes. n_passage_bytes counts the bytes in repeats of
    either kind, removed or not. Strings and words are judged on the input. Null texts are empty. Texts shorter than `least`
    have no repeated string. Rows with equal texts are copies of each other, whatever their ids, and lose all bytes if they have
    `least`. The remaining text drops what a cut leaves of a character. Texts may have any length; columns other than those
    named play no part. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    texts, sizes, ranges = repeated_ranges(docs, text_col, least)
    ranges = ranges.withColumn("gone", F.lit(True))
    if words:
        ranges = ranges.union(repeated_words(texts, words, least).withColumn("gone", F.lit(cut_words)))
    ranges = cut(joined_up(ranges))

    whole = F.struct(F.lit(0).alias("first"), F.col("size").cast("int").alias("last"), F.lit(True).alias("gone"))
    # copies of a text repeat in full and have no other range
    copied = sizes.where((F.col("copies") > 1) & (F.col("size") >= least)).select("key", F.array(whole).alias("found"))
    gathered = cut(ranges.groupBy("key").agg(F.collect_list(F.struct("first", "last", "gone")).alias("found")).union(copied))
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = [F.col(id_col).alias("__id"), *(F.col(c).alias(f"__keep_{c}") for c in keep or [])]
    first = len(own)
    rows = docs.select(*own, F.unhex(F.md5(text)).alias("key"), text.alias("__text"))
    # only texts with ranges, and a few others, move to them
    rows = marked(rows, gathered, "key", "touched")
    found = rows.where("touched").join(gathered, "key", "left").select(*rows.columns[:first], "__text", "found")
    kinds = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string", "n_passage_bytes": "long", "kept_text": "string"}
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields[:first]), *(f"{name} {kind}" for name, kind in kinds.items())])

    def judge(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for text, ranges in zip(*(batch.column(first + k).to_pylist() for k in range(2)), strict=True):
                data = text.encode()
                gone = merged([(r["first"], r["last"]) for r in ranges or [] if r["gone"]])
                left = b"".join(data[a:b] for a, b in zip([0, *(last for _, last in gone)], [*(first for first, _ in gone), len(data)], strict=True))
                passages = sum(b - a for a, b in merged([(r["first"], r["last"]) for r in ranges or []]))
                values = (len(data), sum(b - a for a, b in gone), len(gone), hashlib.sha256(left).hexdigest(), passages, left.decode("utf-8", "ignore") if with_text else None)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            made = [pa.array(c, pa.string() if kind == "string" else pa.int64()) for c, kind in zip(out, kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(first)), *made], [*batch.schema.names[:first], *kinds])

    found = found.mapInArrow(T.tidied(judge), schema)
    zero = F.lit(0).cast("long")
    size = F.octet_length("__text").cast("long").alias("n_bytes")
    same = rows.where("NOT touched").select(*rows.columns[:first], size, zero.alias("n_removed"), zero.alias("n_spans"), F.sha2("__text", 256).alias("kept_sha256"), zero.alias("n_passage_bytes"), F.col("__text").alias("kept_text"))
    joined = found.unionByName(same)
    columns = [c for c in kinds if with_text or c != "kept_text"]
    return joined.select(F.col("__id").alias(id_col), *(F.col(f"__keep_{c}").alias(c) for c in keep or []), *columns)
