"""Plain Lloyd clustering of vectors in exact integers.

Every round broadcasts the centroids; tasks work out integer squared differences to each centroid in numpy, take the lowest
numbered nearest one, and add up their vectors by cluster; a grouped sum of these few rows gives the next centroids. No vector
is shuffled. The vectors are read once a round from where `vectors` comes from, so give a stored table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components up to this size are worked on as 64-bit integers: a squared distance of 64 of them stays below 2**62.
SMALL = 1 << 27
#: Larger ones are Python integers; their sums travel in parts of so many bits, so that 2**33 rows of them fit a long.
PART = 30
LONG = (1 << 63) - 1
#: Distances worked on at once.
BLOCK = 1 << 20


def usable(vector: Column, size: int) -> Column:
    """Whether a vector has exactly `size` components, none null or non-finite."""
    infinity = F.lit(float("inf"))
    return F.coalesce((F.size(vector) == size) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinity)), F.lit(False))


def integers(vectors: pd.Series, scale: int, size: int) -> np.ndarray:
    """floor(scale * x) of every component, as 64-bit integers, or as Python integers if one is over SMALL."""
    if not len(vectors):
        return np.zeros((0, size), np.int64)
    x = np.stack(vectors.to_list()).astype(np.float64)
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if np.abs(y).max(initial=0) <= SMALL:
        return y.astype(np.int64)
    return np.array([[int(b) if math.isfinite(b) else int(a) * scale for a, b in zip(*row, strict=True)] for row in zip(x, y, strict=True)], object)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of every row of x: the nearest centroid, the first of equally near ones."""
    if x.dtype == object or centroids.dtype == object:
        x, centroids = x.astype(object), centroids.astype(object)
    step = max(1, BLOCK // max(1, centroids.shape[1]))
    cluster, distance = np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype)
    for first in range(0, len(x), step):
        part = x[first : first + step]
        d = np.stack([((part - c) ** 2).sum(1) for c in centroids], 1)
        best = d.argmin(1)
        cluster[first : first + step], distance[first : first + step] = best, d[np.arange(len(part)), best]
    return cluster, distance


def parts(total: np.ndarray, large: bool) -> Iterator[np.ndarray]:
    """Integers that make up `total` times 2**PART by their place; all but the last are below 2**PART."""
    while large and np.abs(total).max(initial=0) >= 1 << PART:
        yield total & ((1 << PART) - 1)
        total = total >> PART
    yield total


def assigned(vectors: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """(id, cluster, distance) of every row (id, vector); distance is null where it's no long."""
    held, size = vectors.sparkSession.sparkContext.broadcast(centroids), centroids.shape[1]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cluster, distance = nearest(integers(frame["vector"], scale, size), held.value)
            if distance.dtype == object:
                distance = pd.array([d if d <= LONG else None for d in distance], "Int64")
            yield pd.DataFrame({"id": frame["id"], "cluster": cluster.astype(np.int32), "distance": distance})

    return vectors.mapInPandas(run, f"id {vectors.schema['id'].dataType.simpleString()}, cluster int, distance long")


def moved(vectors: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """The floored means of the vectors nearest to each centroid; a centroid without vectors stays."""
    spark, (k, size) = vectors.sparkSession, centroids.shape
    held = spark.sparkContext.broadcast(centroids)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        small, count, large = np.zeros((k, size), np.int64), np.zeros(k, np.int64), None
        for frame in frames:
            x = integers(frame["vector"], scale, size)
            cluster, _ = nearest(x, held.value)
            count += np.bincount(cluster, minlength=k)
            if not len(x):
                continue
            order = np.argsort(cluster, kind="stable")
            own, at = np.unique(cluster[order], return_index=True)
            if x.dtype == object and large is None:
                large = np.zeros((k, size), object)
            (large if x.dtype == object else small)[own] += np.add.reduceat(x[order], at)
        yield pd.DataFrame({"cluster": np.arange(k, dtype=np.int32), "component": np.int32(-1), "place": np.int32(0), "total": count})
        cells = np.repeat(np.arange(k, dtype=np.int32), size), np.tile(np.arange(size, dtype=np.int32), k)
        for sums in (small, large):
            for place, part in enumerate(parts(sums, sums is large) if sums is not None else ()):
                yield pd.DataFrame({"cluster": cells[0], "component": cells[1], "place": np.int32(place), "total": part.ravel().astype(np.int64)})

    # k * (size + 1) rows, and as many again for each place of large components
    sums = vectors.mapInPandas(run, "cluster int, component int, place int, total long").groupBy("cluster", "component", "place").agg(F.sum("total").alias("total")).collect()
    held.destroy()
    count, total = [0] * k, [[0] * size for _ in range(k)]
    for r in sums:
        if r.component < 0:
            count[r.cluster] += r.total
        else:
            total[r.cluster][r.component] += r.total << (PART * r.place)
    return exact([[v // n for v in row] if n else list(old) for row, n, old in zip(total, count, centroids.tolist(), strict=True)])


def exact(rows: list[list[int]]) -> np.ndarray:
    """Rows of integers as 64-bit ones, or as Python integers if one is over SMALL."""
    return np.array(rows, np.int64 if all(abs(v) <= SMALL for row in rows for v in row) else object)


def lloyd(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, rounds: int = 10, scale: int = 1024, size: int = 64, seed: str = "3") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that has `size` finite components.

    A component x becomes floor(scale * x). The first centroids are the k vectors whose ids have the smallest sha256 of `seed`:id, in
    ascending order; of rows that share an id the one with the smallest vector comes first, a null id comes last. With fewer vectors
    there are fewer centroids. Of equally near centroids the lower number wins; an empty cluster keeps its centroid; rows that repeat an id
    count one by one; other columns play no part; an empty table, or one without such vectors, gives an empty result.
    Components may be any finite doubles; a distance or a sum of distances that is no long is null.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(usable(F.col("vector"), size))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(order.asc_nulls_last(), "vector").limit(k).toPandas()
    out = f"{id_col} {vectors.schema[id_col].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if first.empty:
        return spark.createDataFrame([], out)
    centroids = exact(integers(first["vector"], scale, size).tolist())
    for _ in range(rounds):
        centroids = moved(kept, centroids, scale)
    found = assigned(kept, centroids, scale)
    # one row per cluster
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("beyond")).collect()
    long = lambda rows: v if not any(r.beyond for r in rows) and (v := sum(int(r.total) for r in rows)) <= LONG else None
    whole = long(sums)
    facts = [(r.cluster, long([r]), whole, hashlib.sha256(",".join(map(str, centroids[r.cluster].tolist())).encode()).hexdigest()) for r in sums]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
