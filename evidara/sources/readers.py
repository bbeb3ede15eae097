"""Readers of landed files: CSV indexes, JSON lines, GeoJSON, prefetch manifests, binary files with their hashes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = "type string, features array<struct<type: string, id: string, properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
MANIFEST = (
    "schemaVersion int, status string, generatedAt timestamp, runner string, tlsVerification string, liveApplications int, documentsDownloaded int, totalBytes bigint, "
    "entries array<struct<url: string, finalUrl: string, file: string, kind: string, applicationReference: string, bytes: bigint, sha256: string, mime: string>>"
)


def normal_name(name: str) -> str:
    """A header in lower case with letters and digits only."""
    return re.sub(r"[^a-z0-9]", "", name.lower())


def read_csv(spark: SparkSession, path: str, drop_empty: bool = True) -> DataFrame:
    """A CSV file with quoted fields and normalised headers, all columns strings; rows without any value go with `drop_empty`."""
    rows = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True, ignoreTrailingWhiteSpace=False)
    rows = rows.toDF(*(normal_name(c.lstrip("﻿")) for c in rows.columns))
    if drop_empty and rows.columns:
        rows = rows.where(F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in rows.columns)).isNotNull())
    return rows


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, compressed or not; lines that aren't JSON are dropped."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A row per feature of GeoJSON files: id, name, properties, geometry_type, coordinates as JSON text, x and y bounds.

    The bounds come from all numbers of the coordinates, taken in pairs, so geometry may be nested to any depth.
    """
    rows = spark.read.schema(FEATURES).json(path, multiLine=True).select(F.posexplode("features").alias("pos", "f"))
    numbers = F.transform(F.regexp_extract_all("f.geometry.coordinates", F.lit(r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)"), F.lit(1)), lambda v: v.cast("double"))
    rows = rows.select("pos", "f", numbers.alias("n"))
    pick = lambda odd: F.filter("n", lambda _, i: i % 2 == odd)
    name = F.coalesce(F.col("f.properties")["name"], F.col("f.properties")["title"], F.col("f.properties")["Name"])
    return rows.select(
        F.coalesce("f.id", F.col("f.properties")["id"], F.concat(F.lit("feature:"), F.col("pos").cast("string"))).alias("id"), name.alias("name"), F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"),
        F.array_min(pick(0)).alias("west"), F.array_min(pick(1)).alias("south"), F.array_max(pick(0)).alias("east"), F.array_max(pick(1)).alias("north"),
    )


def in_box(features: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """Features whose bounds touch the box; those without geometry don't."""
    return features.where((F.col("west") <= east) & (F.col("east") >= west) & (F.col("south") <= north) & (F.col("north") >= south))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The entries of prefetch manifests of schema 1 with status ready or partial, one row each."""
    rows = spark.read.schema(MANIFEST).json(path, multiLine=True).where("schemaVersion = 1 AND status IN ('ready', 'partial')")
    return rows.select("runner", "generatedAt", F.explode("entries").alias("e")).select("runner", "generatedAt", "e.*")


def manifest_faults(entries: DataFrame, hosts: list[str], now, max_age_hours: float = 24.0) -> DataFrame:
    """(url, fault): stale or future entries, hosts that aren't allowed, documents named twice with different content."""
    host = F.lower(F.regexp_extract("url", "^https?://([^/?#]+)", 1))
    age = (F.lit(now).cast("timestamp").cast("double") - F.col("generatedAt").cast("double")) / 3600
    twice = entries.where("kind = 'document'").groupBy("url").agg(F.countDistinct("sha256").alias("n")).where("n > 1").select("url", F.lit("conflict").alias("fault"))
    single = F.when((age > max_age_hours) | (age < -0.25), "stale").when(~host.isin(*hosts), "host").when(F.coalesce("bytes", F.lit(0)) <= 0, "empty")
    return entries.select("url", single.alias("fault")).where("fault IS NOT NULL").union(twice).distinct()


def file_faults(entries: DataFrame, files: DataFrame) -> DataFrame:
    """(url, file, fault) of manifest entries whose file isn't what they say: missing, of other bytes, or of another hash, the first of these.

    entries: url, file (a path within the folder), bytes, sha256; files as `read_files` gives them. Files are found by the last part of their path.
    """
    name = lambda c: F.regexp_extract(c, "([^/]+)$", 1)
    held = files.select(name(F.col("path")).alias("__name"), F.col("bytes").alias("__bytes"), F.col("sha256").alias("__sha")).dropDuplicates(["__name"])
    made = entries.withColumn("__name", name(F.col("file"))).join(held, "__name", "left")
    fault = F.when(F.col("__sha").isNull(), "missing").when(~F.col("bytes").eqNullSafe(F.col("__bytes")), "bytes").when(~F.lower("sha256").eqNullSafe(F.col("__sha")), "sha256")
    return made.select("url", "file", fault.alias("fault")).where("fault IS NOT NULL")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256, mime) of binary files; the type comes from the first bytes, then from the extension."""
    head = F.hex(F.substring("content", 1, 4))
    mime = (
        F.when(F.startswith(head, F.lit("25504446")), "application/pdf").when(F.startswith(head, F.lit("89504E47")), "image/png").when(F.startswith(head, F.lit("FFD8FF")), "image/jpeg")
        .when(head.isin("49492A00", "4D4D002A"), "image/tiff").when(F.rlike(F.lower("path"), F.lit(r"\.json$")), "application/json").otherwise("application/octet-stream")
    )
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), mime.alias("mime"))
