"""The corpus pipeline over `documents`: language ID, quality classifier, near-duplicates, repeated passages, packing.

STAGES lists (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next one's docs; all but the last return the columns of `documents`. Every stage works on all that its predecessor kept.
Null and empty texts, ties, repeated rows, empty tables and extra columns are defined by each stage's operator; extra columns of
`documents` are dropped by the first stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidara.llm import cotraining, language_id, near_duplicates, packing, queries, repeats
from evidara.session import cut, delete, marked, settled, shared_folder, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found: declared is `lang`, the host is `source`; `lang` becomes the language found.

    Rejected are texts that no language explains better than chance, texts without a trigram of letters, and null and empty texts. A
    null language or source is none. Rows that repeat an id are judged one by one; of equal probabilities the language that comes first
    by name wins; extra columns go; an empty table gives an empty result.
    """
    small_batches(spark)
    none = F.lit("")
    found = language_id.identify(docs, docs, "doc_id", F.col("text"), F.col("lang"), none, F.col("source"), F.col("source"), keep=["text", "source", "n_chars"])
    return found.where("accepted").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that co-training on `labels` accepts.

    Null and empty texts have no words, and null metadata are a value of their own. Rows that repeat an id are scored one by one; a score of
    just the limit is accepted; extra columns go; without labels all stay; an empty table gives an empty result.
    """
    small_batches(spark)
    scored = cotraining.classify(docs, queries.table(spark, sf_dir, "labels"), queries.metadata_columns(), keep=COLUMNS[1:])
    return scored.where("accepted").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates: five words, similarity 0.8.

    Of rows that repeat an id the one stays whose text, then language, source and size come first in order. Null and empty texts
    have no near-duplicates; ties go by id; extra columns go; an empty table gives an empty result.
    """
    small_batches(spark)
    linked = settled(lambda: near_duplicates.near_duplicates(docs))
    gone = linked.where("doc_id <> component_id").select("doc_id").distinct()
    again = cut(linked.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    told = marked(docs.select(*COLUMNS), gone, "doc_id", "touched")  # the others are certain to stay and don't move
    left = told.where("NOT touched").drop("touched").union(told.where("touched").drop("touched").join(gone, "doc_id", "left_anti"))
    if again.isEmpty():
        return left
    one = left.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("r")).select("doc_id", "r.*")
    return left.join(again, "doc_id", "left_anti").select(*COLUMNS).unionByName(one)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of more than 50 words, or of 400 bytes or more, that are found at two places; a document that
    has no word left goes.

    n_chars becomes the length of what is left. Null and empty texts go, as they have no word. Rows with equal texts repeat each other
    in full and lose all if they have more than 50 words or 400 bytes, whatever their ids; extra columns go; an empty table gives an empty
    result.
    """
    small_batches(spark)
    found = repeats.remove_repeats(docs, with_text=True, keep=["lang", "source"], words=51)
    return found.where(F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")).select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces packed into sequences of 4096 tokens.

    A null or empty text is one piece, its end. Rows that repeat an id are packed one by one; pieces of equal length are packed in the order
    of their places; an empty table gives an empty result.
    """
    small_batches(spark)
    parts = packing.pieces(docs, queries.WORD_BPE)
    return packing.pack(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("language_id", languages), ("quality_classifier", quality), ("near_duplicates", near_copies), ("repeated_passages", passages), ("packing", packed)]
#: Learned models and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages, each written as Parquet to the checkpoint folder and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for stage, function in STAGES[:-1]:
        path = f"{folder}/{stage}"
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # nothing reads the table before the last one any more
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
