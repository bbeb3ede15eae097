"""Sinks: audit reports, GeoJSON, sealed file manifests, content-addressed names, chunked tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(rows: DataFrame, path: str) -> None:
    """An audit report as JSON lines."""
    rows.write.mode("overwrite").json(path)


def feature_lines(rows: DataFrame, geometry: str, properties: list[str]) -> DataFrame:
    """A GeoJSON feature per row as text: `geometry` is a column of GeoJSON geometry text."""
    return rows.select(F.concat(F.lit('{"type":"Feature","geometry":'), F.col(geometry), F.lit(',"properties":'), F.to_json(F.struct(*properties)), F.lit("}")).alias("value"))


def seal(files: DataFrame) -> DataFrame:
    """A manifest of (path, bytes, sha256) with the content-addressed name of each file; equal contents come once."""
    extension = F.lower(F.regexp_extract("path", r"(\.[A-Za-z0-9]{1,8})$", 1))
    named = files.select("path", "bytes", "sha256", F.concat(F.lit("files/"), "sha256", extension).alias("stored"))
    return named.groupBy("stored", "bytes", "sha256").agg(F.min("path").alias("path"), F.count("*").alias("copies"))


def broken(sealed: DataFrame, files: DataFrame) -> DataFrame:
    """Sealed files that are missing or have another content now."""
    return sealed.select("path", "bytes", "sha256").join(files.select("path", "bytes", "sha256"), ["path", "bytes", "sha256"], "left_anti")


def write_chunks(operations: DataFrame, path: str, side: int = 16) -> None:
    """Voxel operations (x, z, ...) as Parquet in folders by chunk, each chunk's rows in one task."""
    chunked = operations.withColumns({"chunk_x": F.floor(F.col("x") / side).cast("int"), "chunk_z": F.floor(F.col("z") / side).cast("int")})
    chunked.repartition("chunk_x", "chunk_z").write.mode("overwrite").partitionBy("chunk_x", "chunk_z").parquet(path)
