"""Best-fit packing of tokenised documents by a non-negative least squares fit of length patterns.

Only a histogram over lengths (at most `limit` numbers) reaches the driver. The plan made from it says, for each length
and each run of ranks within the length, which sequences and which offset the pieces get; it holds a bounded number of
runs. Ranks come from counts per partition and length.
"""

from __future__ import annotations

import codecs
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidara.llm import textkit as T
from evidara.session import bounded_batches, cut

PIECES = "piece int, start long, length long, ids_crc32 long"
#: Words whose ids a worker holds at most; then it starts anew.
CACHED_WORDS = 600_000
#: Ends of words that are tokenised apart from the letters before them.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
#: Bytes of a-z and of U+00C0 to U+00FF in UTF-8.
LATIN = bytes([*range(97, 123), 0xC3, *range(0x80, 0xC0)])
#: The sign that the byte-level vocabulary has for each byte; spaces stay.
SIGNS = "".join(map(chr, [*range(256, 288), 32, *range(33, 127), *range(289, 323), *range(161, 173), 323, *range(174, 256)]))
_workers: dict[str, WordIds] = {}


class WordIds:
    """A worker's tokenizer with the little-endian unsigned 32-bit ids of the words that it has met, and of the runs that they are made of.

    The tokenizer drops white space, never joins across it, and splits letters from other signs; words with the name of a special
    token go to it whole. The last id of a run of
    letters is marked as a word's end in the vocabulary. So many runs of letters are encoded in one call, and told apart
    by their ends.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        # lower-case runs of LATIN are normal and whole as they are: they need the same model only
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.specials = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for x, i in vocabulary.items() if x.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}

    def one_by_one(self, words: list[bytes]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast([x.decode() for x in words], add_special_tokens=False)]

    def letters(self, runs: list[bytes]) -> list[bytes]:
        """The ids of each run of letters."""
        return self.told_apart(runs, self.tokenizer, b" ".join(runs).decode())

    def latin(self, runs: list[bytes]) -> list[bytes]:
        """The ids of each lower-case run of letters of LATIN."""
        return self.told_apart(runs, self.plain, codecs.charmap_decode(b" ".join(runs), "strict", SIGNS)[0])

    def told_apart(self, runs: list[bytes], tokenizer, text: str) -> list[bytes]:
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        last = np.flatnonzero(self.ends[ids]) + 1
        if len(last) != len(runs) or last[-1] != len(ids):  # a letter that the tokenizer's normaliser takes apart
            return self.one_by_one(runs)
        whole, at = ids.tobytes(), [0, *(last * 4).tolist()]
        return [whole[a:b] for a, b in zip(at, at[1:])]  # noqa: B905

    def learn(self, words: set[bytes]) -> None:
        """Adds the ids of `words`: a word of letters and marks after them is two runs, any other word is one."""
        known, made = self.words, []
        latin, runs, other = set(), set(), set()
        for x in words:
            run, marks = x, b""
            if not x.isalpha():  # of other than ASCII letters
                if b"<|" in x and any(t in x for t in self.specials):
                    other.add(x)
                    continue
                run = x.rstrip(MARKS)
                if not (run.isalpha() or run.decode().isalpha()):
                    other.add(x)
                    continue
                marks = x[len(run) :]
                if marks:
                    other.add(marks)
            run = run.lower()
            if run.isascii():
                latin.add(run)
            elif not run.translate(None, LATIN):
                run = run.decode().lower().encode()
                latin.add(run)
            else:
                runs.add(run)
            if run != x:
                made.append((x, run, marks))
        for some, encode in ((latin, self.latin), (runs, self.letters), (other, self.one_by_one)):
            todo = [x for x in some if x not in known]
            for first in range(0, len(todo), 20_000):
                part = todo[first : first + 20_000]
                known.update(zip(part, encode(part), strict=True))
        for x, run, marks in made:
            known[x] = known[run] + known[marks] if marks else known[run]

    def ids_of(self, texts: list[bytes]) -> list[bytes]:
        split = [x.split() for x in texts]
        known = self.words
        found = [list(map(known.get, words)) for words in split]
        gaps = list(map(gaps_of, found))
        new = {words[k] for words, at in zip(split, gaps, strict=True) for k in at}
        if new:
            if len(known) + len(new) > CACHED_WORDS:
                known.clear()
            self.learn(new)
            for words, ids, at in zip(split, found, gaps, strict=True):
                for k in at:
                    ids[k] = known[words[k]]
        return list(map(b"".join, found))


def gaps_of(values: list) -> list[int]:
    """The places of None."""
    at, k = [], -1
    for _ in range(values.count(None)):
        k = values.index(None, k + 1)
        at.append(k)
    return at


def forget(path: str) -> None:
    """Frees a worker's words, as it may serve other operators after this one."""
    if path in _workers:
        _workers[path].words.clear()


def ids_of(texts: list[bytes], path: str) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of each text in UTF-8, by the worker's cache."""
    if path not in _workers:
        _workers[path] = WordIds(path)
    return _workers[path].ids_of(texts)


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, end_id: int = 1) -> DataFrame:
    """A row for each piece of at most `limit` ids of each document's ids and `end_id`.

    Ids are the tokenizer's by its defaults, without added ones: the names of special tokens in a text are these tokens. A null text
    is empty and has just `end_id`. Rows with the same id are cut one by one; texts may have any length; other columns of `docs`
    play no part; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for rows, _, _ in T.slices(batches, most=1 << 20):
            out: list[list] = [[], [], [], [], []]
            for doc, ids in zip(rows.column(0).to_pylist(), ids_of(rows.column(1).cast(pa.binary()).fill_null(b"").to_pylist(), path), strict=True):
                ids += end
                for k, first in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[first : first + 4 * limit]
                    for column, value in zip(out, (doc, k, first // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], rows.schema.field(0).type), pa.array(out[1], pa.int32()), *(pa.array(x, pa.int64()) for x in out[2:])], ["doc_id", "piece", "start", "length", "ids_crc32"])
        forget(path)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(T.tidied(run), f"doc_id {docs.schema[id_col].dataType.simpleString()}, {PIECES}")


def patterns(counts: np.ndarray, limit: int, each: int = 12, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Patterns of a few lengths that fill a sequence: rows of lengths (0: none) for each length that occurs.

    Each pattern begins with one length, draws others from the histogram while they fit, and ends with the largest
    length that fits the rest.
    """
    have = np.flatnonzero(counts)
    below = np.zeros(limit + 1, np.int64)  # the largest length that occurs, up to each
    below[have] = have
    below = np.maximum.accumulate(below)
    draw = np.random.Generator(np.random.PCG64(seed))
    cum = np.cumsum(counts)
    room = np.repeat(limit - have, each)
    rows = [np.repeat(have, each)]
    depth = np.tile(np.arange(each) % 6, len(have))  # how many are drawn before the last
    for k in range(64):
        top = below[np.maximum(room, 0)]
        if not top.any():
            break
        some = cum[room]
        at = np.searchsorted(cum, draw.random(len(room)) * some, "right")
        pick = np.where(k < depth, np.minimum(at, top), top)
        pick[top == 0] = 0
        rows.append(pick)
        room = room - pick
    made = np.unique(np.sort(np.stack(rows, 1), 1)[:, ::-1], axis=0)
    return made, limit - made.sum(1)


def fit(made: np.ndarray, counts: np.ndarray, steps: int = 300) -> np.ndarray:
    """Non-negative repeat counts x that bring A x close to the histogram, by multiplicative updates."""
    size = len(counts)
    rows, cols = np.nonzero(made)
    lengths = made[rows, cols]
    b = counts.astype(float)
    x = np.full(len(made), b.sum() / max(1, len(lengths)))
    want = np.bincount(rows, b[lengths], len(made))
    for _ in range(steps):
        now = np.bincount(lengths, x[rows], size)
        x *= want / np.maximum(np.bincount(rows, now[lengths], len(made)), 1e-12)
    return x


def plan(counts: np.ndarray, limit: int) -> np.ndarray:
    """Rows (length, first rank, number, first sequence, offset): the pieces of a length with ranks from the first on
    get one sequence each, from the first sequence on. counts[n]: pieces of length n."""
    left = counts.astype(np.int64).copy()
    runs: list[tuple[int, int, int, int, int]] = []
    next_rank = np.zeros(limit + 1, np.int64)
    sequences = 0

    def put(length: int, number: int, sequence: int, offset: int) -> None:
        runs.append((length, int(next_rank[length]), number, sequence, offset))
        next_rank[length] += number
        left[length] -= number

    if left[limit]:
        n = int(left[limit])
        put(limit, n, 0, 0)
        sequences = n
    rest: dict[int, list[tuple[int, int]]] = {}  # room -> runs of sequences (first, number)
    if left.any():
        made, room = patterns(left, limit)
        for row, space, x in sorted(zip(made.tolist(), room.tolist(), fit(made, left).tolist(), strict=True), key=lambda r: -r[2]):
            lengths, times = np.unique([v for v in row if v], return_counts=True)
            n = min(int(x), int((left[lengths] // times).min()))
            if n <= 0:
                continue
            offset = 0
            for v in row:
                if v:
                    put(v, n, sequences, offset)
                    offset += v
            if space:
                rest.setdefault(space, []).append((sequences, n))
            sequences += n
    # what is left, longest first, each into the fullest sequence that has room
    for length in np.flatnonzero(left)[::-1].tolist():
        while left[length]:
            space = min((s for s in rest if s >= length), default=0)
            if not space:
                n = -(-int(left[length]) // max(1, limit // length))
                rest.setdefault(limit, []).append((sequences, n))
                sequences += n
                space = limit
            first, number = rest[space].pop()
            n = min(number, int(left[length]))
            put(length, n, first, limit - space)
            if number > n:
                rest[space].append((first + n, number - n))
            if not rest[space]:
                del rest[space]
            if space > length:
                rest.setdefault(space - length, []).append((first, n))
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def pack(parts: DataFrame, limit: int = 4096) -> DataFrame:
    """`parts` (a row per piece, with its length) with sequence_id and offset added. Rows with equal values are packed one by one.

    Offsets are gapless from 0 in each sequence. An empty table stays empty.
    """
    spark = parts.sparkSession
    kind = parts.schema

    def ranked(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            order = np.argsort(length, kind="stable")
            sort = length[order]
            begin = np.searchsorted(sort, sort)
            local = np.empty(len(length), np.int64)
            local[order] = np.arange(len(length)) - begin + seen[sort]
            seen += np.bincount(length, minlength=limit + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), part, np.int64)), pa.array(local)], [*batch.schema.names, "__part", "__local"])

    rows = cut(parts.mapInArrow(ranked, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind) + ", __part long, __local long"))
    per = rows.groupBy("length", "__part").agg(F.count("*").alias("__n"))
    totals = per.groupBy("length").agg(F.sum("__n").alias("n")).collect()  # at most `limit` rows
    counts = np.zeros(limit + 1, np.int64)
    for r in totals:
        counts[r["length"]] = r["n"]
    runs = spark.sparkContext.broadcast(plan(counts, limit))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = per.withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")

    def placed(batches):
        table = runs.value
        step = int(table[:, 1].max(initial=0) + table[:, 2].max(initial=0)) + 1
        keys = table[:, 0] * step + table[:, 1]
        for batch in batches:
            take = lambda name, b=batch: b.column(b.schema.get_field_index(name)).to_numpy()
            rank = take("__local") + take("__base")
            run = np.searchsorted(keys, take("length") * step + rank, "right") - 1
            names = [f.name for f in kind]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(table[run, 3] + rank - table[run, 1]), pa.array(table[run, 4])], [*names, "sequence_id", "offset"])

    return rows.join(base, ["length", "__part"]).mapInArrow(placed, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind) + ", sequence_id long, offset long")
