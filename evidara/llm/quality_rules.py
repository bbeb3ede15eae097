"""Quality rules over lines that many documents of a host share.

`line_rules` hashes every normalised line (words with A-Z lower-cased, joined by one space), counts for each host the
distinct documents that hold it, removes lines above the limit and rejects documents that lose most of their words.
A document's text with another document's exact text counts once for a host, so plain copies don't make a line frequent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidara.llm import textkit as T
from evidara.session import bounded_batches, cut

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
LINES = "text_hash long, line_no array<int>, line_hash array<long>, line_words array<int>"


def repeated_words(w: T.Words, h: np.ndarray, k: int = 3) -> np.ndarray:
    """Per text, the words that lie in a window of k words found twice or more in the text."""
    x, at = w.windows(h, k)
    covered = np.zeros(len(h) + k, bool)
    # a window's text is part of its key; equal keys lie side by side after the sort
    key = T.mix(x + T.mix(w.text[at].astype(T.U) + T.U(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    for i in range(k):
        covered[at[twice] + i] = True
    return T.sums(covered[: len(h)], np.append(w.first, len(h)))


def measure(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> dict[str, pa.Array]:
    """The base measures and the lines of each text of a slice."""
    w = T.Words(data, at)
    h, lower = w.hashes(), w.hashes(lower=True)
    texts, n = len(at) - 1, len(data)
    chars = T.sums(w.ink & ((data & 0xC0) != 0x80), at)
    # a line starts at a text's start, empty texts aside, and after each \n inside a text
    feeds = np.flatnonzero(data == 0x0A) + 1
    starts = np.unique(np.concatenate([at[:-1][np.diff(at) > 0], feeds[feeds < n]])).astype(np.int64)
    dup, line_no, kept_h, kept_w, per = np.zeros(texts, np.int64), np.zeros(0, np.int32), np.zeros(0, T.U), np.zeros(0, np.int32), np.zeros(texts, np.int64)
    if len(starts) and len(h):
        text = np.searchsorted(at, starts, "right") - 1
        raw = T.mix(T.spans(data, starts, T.LINE_TABLE))
        first = np.searchsorted(w.start, starts)
        words = np.diff(first, append=len(h))
        inked = np.flatnonzero(words)
        text, raw, first, words = text[inked], raw[inked], first[inked], words[inked]
        place = np.arange(len(h)) - np.repeat(first, words)
        norm = T.mix(np.add.reduceat(lower * T.powers(int(words.max()))[place], first))
        key = T.mix(raw + T.mix(text.astype(T.U) + T.U(1)))
        again = np.ones(len(key), bool)
        again[np.unique(key, return_index=True)[1]] = False
        dup = np.bincount(text[again], minlength=texts)
        line_no = (inked - np.searchsorted(starts, at[:-1])[text]).astype(np.int32)
        kept_h, kept_w, per = norm, words.astype(np.int32), np.bincount(text, minlength=texts)
    whole = np.zeros(texts, T.U)
    if n:
        full = np.diff(at) > 0
        whole[full] = T.mix(T.spans(data, at[:-1][full], T.LINE_TABLE + T.U(1)))
    return {
        "n_words": pa.array(w.count.astype(np.int64)), "word_chars": pa.array(chars), "n_symbols": pa.array(T.sums(SYMBOLS[data], at)), "n_dup_lines": pa.array(dup.astype(np.int64)),
        "n_repeat_words": pa.array(repeated_words(w, h)), "text_hash": pa.array(T.signed(whole)),
        "line_no": T.lists(line_no, per), "line_hash": T.lists(T.signed(kept_h), per), "line_words": T.lists(kept_w, per),
    }


def measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per row of `docs`: row_id, the id, the host, the base measures and the inked lines."""

    def run(batches):
        for rows, data, at in T.slices(batches):
            got = measure(rows, data, at)
            yield pa.RecordBatch.from_pydict({"doc_id": rows.column(0), "host": rows.column(1), **got})

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, host string, {MEASURES}, {LINES}")


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_documents: int = 20, max_share: float = 0.02, max_documents: int = 10_000, max_removed: float = 0.5, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """Per row of `docs`: the base measures, base_failed, the numbers of the lines to remove (from 0), kept.

    A line goes when more than `min_documents` distinct documents of its host hold it and these are more than
    `max_share` of the host's distinct documents or more than `max_documents`. Texts may have any length. A document with more than `max_removed` of its words in such lines is
    depleted and rejected. Null text counts as empty, a null host as the host ''; rows with the same id are judged one by one; other columns
    of `docs` play no part. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    rows = cut(measured(docs, id_col, text_col, host_col).withColumn("row_id", F.monotonically_increasing_id()))
    # exact copies within a host count once; what is counted is combined before each shuffle
    lines = rows.select("row_id", "host", "text_hash", F.explode(F.arrays_zip("line_no", "line_hash", "line_words")).alias("l")).select("row_id", "host", "text_hash", "l.*")
    holders = lines.groupBy("host", "line_hash").agg(F.countDistinct("text_hash").alias("holders")).where(F.col("holders") > min_documents)
    sizes = rows.groupBy("host").agg(F.countDistinct("text_hash").alias("host_documents"))
    frequent = cut(holders.join(sizes, "host").where((F.col("holders") > max_share * F.col("host_documents")) | (F.col("holders") > max_documents)).select("host", "line_hash"))
    # a hot line meets its one row of `frequent` in as many pieces as there are salts
    salts = 16
    removed = (
        lines.withColumn("salt", F.pmod(F.col("row_id"), F.lit(salts)))
        .join(frequent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>"))), ["host", "line_hash", "salt"])
        .groupBy("row_id")
        .agg(F.sum("line_words").alias("removed_words"), F.array_sort(F.collect_list("line_no")).alias("removed_lines"))
    )
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return (
        rows.drop("text_hash", "line_no", "line_hash", "line_words")
        .join(removed, "row_id", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
        .withColumn("removed_lines", F.coalesce("removed_lines", F.array().cast("array<int>")))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("removed_words") <= max_removed * F.col("n_words")))
        .drop("row_id")
    )


def cleaned(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept documents of `docs` with the frequent lines taken out of the text; ids must be unique."""
    said = verdicts.where("kept").select(F.col("doc_id").alias("__id"), F.col("removed_lines").alias("__gone"))
    whole = F.split(F.col(text_col), "\n", -1)
    left = F.array_join(F.filter(whole, lambda _, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    return docs.join(said, F.col(id_col) == F.col("__id")).withColumn(text_col, F.when(F.size("__gone") > 0, left).otherwise(F.col(text_col))).drop("__id", "__gone")
