"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

A task takes the distinct words of its texts; higher-order functions fold each word's bytes into ids, merging the pair of
neighbours of least rank until none has a rank, and concatenate the ids' binary pieces for decoding. The rank map and the
pieces are literals in the plan: the map is a sparse matrix with its rows laid over each other (pair of ids -> id of their union), so
that a look-up takes constant time. The texts' words are then put together by number in the same stage, without a shuffle.

The words that a sample of the texts holds most often are folded once and broadcast. They only save time: a word that isn't among
them is folded by each task that meets it, so ids don't depend on the sample.
"""

from __future__ import annotations

import base64
import collections
import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.llm import textkit as T
from evidara.session import bounded_batches, cut, drop

#: Texts of the sample whose frequent words are folded once, and so many words at most.
SAMPLED, SHARED_WORDS = 32_000, 300_000
#: An entry that no pair has.
NONE = 1 << 40
#: Words that a task numbers before it starts anew.
NUMBERED = 300_000
#: Words of more bytes are merged by a heap in Python, as folding takes time with the square of the length.
LONG_WORD = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of base64 pieces and numbers."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(shifts, entries): the pair (a, b) has a * 65536 + id of its union at shifts[a] + b; other pairs have other entries there."""
    rows: dict[int, dict[int, int]] = {}
    for piece, rank in ranks.items():
        for i in range(1, len(piece)):
            if piece[:i] in ranks and piece[i:] in ranks:
                rows.setdefault(ranks[piece[:i]], {})[ranks[piece[i:]]] = rank
    size = max(ranks.values()) + 1
    room = 5 * size + 2 * sum(map(len, rows.values())) + 8192
    free, shifts, entries = np.ones(room, bool), np.zeros(size, np.int64), np.full(room, NONE, np.int64)
    low = 0
    single = [a for a, own in rows.items() if len(own) == 1]
    for a, own in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        if len(own) == 1:
            break
        b = np.array(sorted(own))
        at = max(low, int(b[0]))
        while True:  # the first place where all entries of the row are free
            if at + 4096 + size > len(free):
                free, entries = np.append(free, np.ones(room, bool)), np.append(entries, np.full(room, NONE))
            found = np.flatnonzero(free[at : at + 4096]) + at
            for x in (b - b[0])[1:].tolist():
                found = found[free[found + x]]
            if len(found):
                break
            at += 4096
        shifts[a] = found[0] - b[0]
        free[b + shifts[a]] = False
        entries[b + shifts[a]] = [a << 16 | own[x] for x in b.tolist()]
        low += int(np.argmax(free[low:]))
    places = np.flatnonzero(free[size:])[: len(single)] + size
    for a, place in zip(sorted(single), places.tolist(), strict=True):
        ((b, rank),) = rows[a].items()
        shifts[a], entries[place] = place - b, a << 16 | rank
    return shifts, entries[: int(shifts.max(initial=0)) + size]


def literal(values: np.ndarray, kind: str) -> Column:
    """An array that the optimizer folds to a literal."""
    return F.split(F.lit(",".join(map(str, values.tolist()))), ",").cast(f"array<{kind}>")


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a long word: pairs leave a heap by rank, then place."""
    n = len(word)
    follow, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = bytearray(b"\1") * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, until = heapq.heappop(heap)
        j = follow[i]
        if not alive[i] or j >= n or end[j] != until:
            continue
        end[i], follow[i], alive[j] = until, follow[j], 0
        if follow[i] < n:
            before[follow[i]] = i
            k = end[follow[i]]
            if (r := ranks.get(word[i:k])) is not None:
                heapq.heappush(heap, (r, i, k))
        p = before[i]
        if p >= 0 and (r := ranks.get(word[p:until])) is not None:
            heapq.heappush(heap, (r, p, until))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def bound(x: Column, like: Column, body) -> Column:
    """`body` of x, x worked out once; `like` is any value of the body's type.

    A fold over one element: indexing a transformed array instead would work out the body's type anew for every word.
    """
    return F.aggregate(F.array(x), like, lambda _, v: body(v))


class Codec:
    """Expressions over words (binary columns) for a rank file."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        if max(self.ranks.values()) >= 1 << 16:
            raise ValueError("ids of more than 16 bits")
        shifts, entries = pair_table(self.ranks)
        self.shifts, self.entries = literal(shifts, "int"), literal(entries, "bigint")
        self.of_byte = literal(np.array([self.ranks[bytes([b % 256])] for b in range(-128, 128)]), "bigint")
        by_id = {i: piece for piece, i in self.ranks.items()}
        pieces = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.blob = F.lit(bytearray(b"".join(pieces)))
        self.begin = literal(np.concatenate([[0], np.cumsum([len(x) for x in pieces])]), "int")

    def united(self, a: Column, b: Column) -> Column:
        """The id of a's piece followed by b's; 65536 or more if they have none."""
        return F.get(self.entries, F.get(self.shifts, a.cast("int")) + b.cast("int")).bitwiseXOR(F.shiftleft(a, 16))

    def encode(self, word: Column) -> Column:
        """The ids of a word, an array of its bytes from -128 to 127."""
        start = F.transform(word, lambda b: F.get(self.of_byte, b.cast("int") + 128))

        def merged(ids: Column, _) -> Column:
            # the last id's partner is null, and so is their union
            united = F.zip_with(ids, F.slice(ids, 2, F.size(ids)), self.united)

            def least(found: Column) -> Column:
                m = F.array_min(found)
                return F.when(m >= 1 << 16, ids).otherwise(self.joined(ids, m, F.array_position(found, m).cast("int")))

            return F.when(F.size(ids) == 1, ids).otherwise(bound(united, ids, least))

        return F.aggregate(F.slice(word, 2, F.size(word)), start, merged).cast("array<int>")

    def joined(self, ids: Column, least: Column, at: Column) -> Column:
        """`ids` with the pair at place `at` united."""
        return F.concat(F.slice(ids, F.lit(1), at - 1), F.array(least), F.slice(ids, at + 2, F.size(ids)))

    def decode(self, ids: Column) -> Column:
        """The bytes of ids."""
        piece = lambda i: F.substring(self.blob, F.get(self.begin, i) + 1, F.get(self.begin, i + 1) - F.get(self.begin, i))
        return F.aggregate(ids, F.lit(bytearray()), lambda a, i: F.concat(a, piece(i)))


class _Numbers(dict):
    """Numbers words in the order in which they are asked for, and lists those that are new."""

    new: list[str]

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


@dataclass
class Shared:
    """Words that every task knows: their numbers, and by number how many ids, the ids and the bytes that they decode to."""

    numbers: dict[str, int]
    counts: np.ndarray
    ids: list[bytes]
    decoded: list[bytes]


def byte_lists(words: list[bytes]) -> pa.Array:
    """Words as arrays of bytes from -128 to 127."""
    return T.lists(np.frombuffer(b"".join(words), np.int8), np.array([len(w) for w in words], np.int64))


def listed(tokens: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """How many ids each of the lists has, and the ids as decimals, each with a comma after it."""
    at = tokens.offsets.to_numpy()
    names = [b"%d," % i for i in tokens.flatten().to_numpy().tolist()]
    edge = (at - at[0]).tolist()
    return np.diff(at), [b"".join(names[a:b]) for a, b in zip(edge, edge[1:])]  # noqa: B905


def shared_words(texts: DataFrame, codec: Codec, pattern: str, sampled: int, most: int) -> Shared:
    """Words that a sample of `texts` (id, text) holds twice or more, the most frequent ones, `most` at most."""
    some = texts.where(F.rand(9) < sampled / max(1, texts.count())).select("text")

    def count(batches):
        import regex

        find, total = regex.compile(pattern).findall, collections.Counter()
        for rows, _, _ in T.slices(batches):
            for text in rows.column(0).to_pylist():
                total.update(find(text or ""))
        short = {w: n for w, n in total.items() if len(w.encode()) <= LONG_WORD}
        yield pa.RecordBatch.from_arrays([pa.array(short, pa.string()), pa.array(short.values(), pa.int64())], ["word", "n"])

    words = cut(some.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"))
    least = 2
    level = F.least("n", F.lit(10_000))
    for r in sorted(words.groupBy(level.alias("n")).agg(F.count("*").alias("k")).collect(), reverse=True):  # at most 10,000 rows
        most -= r["k"]
        if most < 0:
            least = r["n"] + 1
            break

    def spread(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), byte_lists([w.encode() for w in batch.column(0).to_pylist()])], ["word", "bytes"])

    folded = words.where(level >= least).select("word").mapInArrow(spread, "word string, bytes array<tinyint>").select("word", codec.encode(F.col("bytes")).alias("ids"))
    found = folded.withColumn("decoded", codec.decode(F.col("ids"))).toArrow().combine_chunks()
    drop(words)
    if not found.num_rows:
        return Shared({}, np.zeros(0, np.int64), [], [])
    counts, ids = listed(found["ids"].combine_chunks())
    return Shared({w: i for i, w in enumerate(found["word"].to_pylist())}, counts, ids, found["decoded"].to_pylist())


def split_words(texts: DataFrame, pattern: str, shared: Broadcast) -> DataFrame:
    """Rows of several texts of (id, text): their ids, words per text, the words by number, and the words not met before in the task.

    With `anew`, numbering starts anew with this row, after the shared words. Words come as arrays of bytes; long ones only by their
    bytes' place among the words, with an empty array.
    """
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches):
        import regex

        known = shared.value.numbers
        find, numbers, anew = regex.compile(pattern).findall, _Numbers(known), True
        for rows, _, _ in T.slices(batches, most=1 << 20):
            if len(numbers) > len(known) + NUMBERED:
                numbers, anew = _Numbers(known), True
            numbers.new = []
            per, code = [], []
            for text in rows.column(1).to_pylist():
                words = find(text or "")
                per.append(len(words))
                code.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            new = [w.encode() for w in numbers.new]
            words = byte_lists([w if len(w) <= LONG_WORD else b"" for w in new])
            one = lambda values, count: T.lists(values, np.array([count]))
            columns = [
                pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(0)), one(np.array(per, np.int32), len(per)),
                pa.array([np.concatenate([np.zeros(0, np.int32), *code]).astype("<i4").tobytes()], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(new)], pa.int32()), words),
                pa.ListArray.from_arrays(pa.array([0, sum(len(w) > LONG_WORD for w in new)], pa.int32()), pa.array([w for w in new if len(w) > LONG_WORD], pa.binary())), pa.array([anew]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["ids", "per", "codes", "words", "long", "anew"])
            anew = False

    return texts.mapInArrow(run, f"ids array<{kind}>, per array<int>, codes binary, words array<array<tinyint>>, long array<binary>, anew boolean")


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, sampled: int = SAMPLED, shared: int = SHARED_WORDS) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, and with `with_ids` token_ids and decoded) per row of `docs`.

    Every match of `pattern` is encoded by itself, without special tokens. A null text is empty and has no ids. The hashes are of
    the decimal ids joined by commas and of the decoded bytes, as lower-case hex. Rows with the same id are encoded one by one;
    texts may have any length; other columns of `docs` play no part; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    codec = Codec(path)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    head = docs.sparkSession.sparkContext.broadcast(shared_words(texts, codec, pattern, sampled, shared))
    rows = split_words(texts, pattern, head)
    folded = rows.withColumn("tokens", F.transform("words", codec.encode)).drop("words")
    folded = folded.withColumn("pieces", F.transform("tokens", codec.decode))

    def run(batches):
        known = head.value
        ranks = pieces = None
        sizes, ids, decoded = known.counts, list(known.ids), list(known.decoded)
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name, row=row, batch=batch: batch.column(batch.schema.get_field_index(name))[row]
                if get("anew").as_py():
                    sizes, ids, decoded = known.counts, list(known.ids), list(known.decoded)
                count, names = listed(get("tokens").values)
                parts = get("pieces").as_py()
                if not count.all():  # long words
                    count, long = count.copy(), iter(get("long").as_py())
                    for i in np.flatnonzero(count == 0).tolist():
                        if ranks is None:
                            ranks = read_ranks(path)
                            pieces = {i: p for p, i in ranks.items()}
                        found = merge_long(next(long), ranks)
                        count[i], names[i], parts[i] = len(found), b"".join(b"%d," % x for x in found), b"".join(map(pieces.__getitem__, found))
                sizes = np.concatenate([sizes, count])
                ids += names
                decoded += parts
                code = np.frombuffer(get("codes").as_py(), "<i4")
                edge = np.concatenate([[0], np.cumsum(get("per").values.to_numpy())])
                total = np.concatenate([[0], np.cumsum(sizes[code])]) if len(code) else np.zeros(1, np.int64)
                numbers, out = code.tolist(), [[], [], [], [], []]
                for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    some = numbers[a:b]
                    text_ids, text = b"".join(map(ids.__getitem__, some))[:-1], b"".join(map(decoded.__getitem__, some))
                    values = (int(total[b] - total[a]), hashlib.sha256(text_ids).hexdigest(), hashlib.sha256(text).hexdigest(), [int(x) for x in text_ids.split(b",") if x] if with_ids else None, text if with_ids else None)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                columns = [get("ids").values, pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()), pa.array(out[3], pa.list_(pa.int32())), pa.array(out[4], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns[: 6 if with_ids else 4], [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "token_ids", "decoded"][: 6 if with_ids else 4])

    more = ", token_ids array<int>, decoded binary" if with_ids else ""
    return folded.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
