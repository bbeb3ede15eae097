"""Session helpers: local sessions for tests, and lineage cuts that work on a cluster."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tells Spark to delete an action's shuffle files when the action has ended.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Settings of the batches that go to Python workers.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
SMALL = {"spark.sql.execution.arrow.maxRecordsPerBatch": "250", "spark.sql.execution.arrow.maxBytesPerBatch": "2m"}
SMALLER = "spark.evidara.smallBatches"

#: Bits of a broadcast filter of keys, a power of two: a million rows of 64.
MOST_BITS = 1 << 26


def local_session(cpus: str = "8", name: str = "evidara") -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the session's spark.checkpoint.dir, which all executors share; a temporary one only in a local session."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not named:
            named = tempfile.mkdtemp(prefix="evidara-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Actions in this block leave no shuffle files behind."""
    if not spark.conf.isModifiable(FREED):  # an older Spark
        yield
        return
    before = spark.conf.get(FREED)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def bounded_batches(spark: SparkSession) -> None:
    """Python workers of this session get Arrow batches of few rows and bytes from here on, as texts may be long, unless `small_batches` has set smaller ones."""
    if spark.conf.get(SMALLER, "") != "true":
        for name, value in BATCHES.items():
            spark.conf.set(name, value)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """`df` dealt out by `keys` to a few tasks for each core: a table of little size but of much work for each row would else be read by one task."""
    spark = df.sparkSession
    return df.repartition(max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def large(df: DataFrame) -> DataFrame:
    """`df`, which grows with the input, as a side of a join: it is never broadcast, as Spark takes the size of a compressed file for that of its rows."""
    return df.hint("merge")


def marked(df: DataFrame, keys: DataFrame, on: str, name: str) -> DataFrame:
    """`df` with the boolean column `name`: true if `on` is in the column `on` of `keys`, and for about one in sixteen of the other rows; false is certain.

    Told by a broadcast of 16 bits a key, at most MOST_BITS in all, beyond which more rows are true. So a join with `keys` that follows
    moves few rows that it doesn't need, and none moves that is false.
    """
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(10, (16 * keys.count()).bit_length()))

    def places(key: Column) -> list[Column]:
        place = F.pmod(F.xxhash64(key), F.lit(bits))
        return [F.shiftright(place, 6).alias("__word"), place.bitwiseAND(F.lit(63)).cast("int").alias("__place")]

    bit = F.expr("shiftleft(1L, __place)")
    words = keys.select(*places(F.col(on))).groupBy("__word").agg(F.bit_or(bit).alias("__bits"))
    told = df.select("*", *places(F.col(on))).join(F.broadcast(words), "__word", "left")
    return told.withColumn(name, F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))).select(*df.columns, name)


def likely(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows of `df` whose `on` is in `keys`, and a few others (see `marked`): what is left of a large side before it is joined with few keys."""
    return marked(df, keys, on, "__likely").where("__likely").drop("__likely")


def small_batches(spark: SparkSession) -> None:
    """The same with still smaller batches, for runs of many operators in one session, where executors hold little free memory."""
    spark.conf.set(SMALLER, "true")
    for name, value in SMALL.items():
        spark.conf.set(name, value)


#: Tables that `cut` has made and nothing has deleted yet.
_made: dict[str, SparkSession] = {}
#: Those made within `settled`.
_own: ContextVar[list[str] | None] = ContextVar("own", default=None)


def release() -> None:
    """Deletes all tables that `cut` has made in this process. Call it when no frame made from them is needed any more; it is also called at its end."""
    for path, spark in list(_made.items()):
        with contextlib.suppress(Exception):  # the session may have ended
            delete(spark, path)
        _made.pop(path, None)


atexit.register(release)


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder as Parquet and read back, so that later stages don't recompute it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made.cut_path = path
    _made[path] = spark
    if (own := _own.get()) is not None:
        own.append(path)
    return made


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """The frame that `make` returns, as a table like `cut`'s; the tables that `make` has cut on the way are deleted."""
    own: list[str] = []
    token = _own.set(own)
    try:
        done = cut(make())
    finally:
        _own.reset(token)
    if (outer := _own.get()) is not None:
        outer.append(done.cut_path)
    for path in own:
        if path in _made and path != done.cut_path:
            delete(done.sparkSession, path)
    return done


def drop(*frames: DataFrame) -> None:
    """Deletes the tables behind frames made by `cut`, which nothing may read any more."""
    for df in frames:
        delete(df.sparkSession, df.cut_path)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system."""
    _made.pop(path, None)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
