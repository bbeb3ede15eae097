"""Exact top-k by inner product with the threshold algorithm over sorted per-dimension lists.

Vectors are dealt into blocks of bounded size. A task holds one block of queries and one of candidates, sorts the block's
components once per dimension, and walks the lists of a query from their better end, scoring each row when it is first
met. It stops a query when the sum of the next list entries can't reach the k-th score. Blocks' best are merged by rank.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidara.session import cut


def threshold_top_k(query: np.ndarray, own: int, rows: np.ndarray, ids: np.ndarray, row_ids: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores, rows met) of the k best of `rows` other than row `own`, ties to the smaller id.

    `order[j]` lists the rows by rising component j. Arithmetic is exact as long as all sums stay below 2**53.
    """
    n, used = len(rows), np.flatnonzero(query)
    met = np.zeros(n, bool)
    best_ids, best = np.zeros(0, np.int64), np.zeros(0, rows.dtype)
    weight = query[used]
    up = weight > 0
    depth, step, seen = 0, max(8, 4 * k), 0
    while depth < n:
        until = min(n, depth + step)
        # the better end of a list is its last entry for a positive weight, else its first
        at = np.arange(depth, until)
        got = order[used[:, None], np.where(up[:, None], n - 1 - at, at)].ravel() if len(used) else np.arange(depth, until)
        fresh = np.zeros(n, bool)
        fresh[got] = True
        fresh &= ~met
        met |= fresh
        new = np.flatnonzero(fresh)
        seen += len(new)
        new = new[row_ids[new] != own]
        if len(new):
            best_ids, best = np.concatenate([best_ids, ids[new]]), np.concatenate([best, rows[new] @ query])
            top = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[top], best[top]
        depth, step = until, step * 2
        if depth < n and len(best) == k:
            ends = np.where(up, n - 1 - depth, depth)
            bound = weight @ rows[order[used, ends], used] if len(used) else 0
            if best[-1] > bound or (not len(used) and seen == n):
                break
    return best_ids, best, seen


def whole(x: float, scale: int) -> int:
    """floor(scale * x); from 2**53 on x is a whole number."""
    return int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale)


def block_top_k(queries: pd.DataFrame, found: pd.DataFrame, k: int, scale: int) -> pd.DataFrame:
    """The k best of one block of candidates for each query of one block."""
    names = ["query_row", "query_id", "vec_id", "score"]
    if not len(queries) or not len(found):
        return pd.DataFrame({x: np.zeros(0, np.int64) for x in names})
    width = max(max(map(len, queries["v"])), max(map(len, found["v"])), 1)

    def dense(column: pd.Series) -> np.ndarray:
        out = np.zeros((len(column), width))
        for i, x in enumerate(column):
            out[i, : len(x)] = x
        return out

    q, rows = dense(queries["v"]), dense(found["v"])
    bound = [float(np.abs(x).max()) * scale + 1 for x in (q, rows)]
    if max(bound) < 2.0**53 and bound[0] * bound[1] * width < 2.0**53:
        q, rows = np.floor(q * scale), np.floor(rows * scale)
    else:  # Python's integers
        q, rows = (np.vectorize(lambda v: whole(v, scale), [object])(x) for x in (q, rows))
    ids, row_ids = found["vec_id"].to_numpy(), found["row_id"].to_numpy()
    order = np.argsort(rows.T, axis=1, kind="stable")
    out = []
    for row, query_id, x in zip(queries["row_id"], queries["vec_id"], q, strict=True):
        got, scores, _ = threshold_top_k(x, row, rows, ids, row_ids, order, k)
        out.append(pd.DataFrame({"query_row": row, "query_id": query_id, "vec_id": got, "score": np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64)}))
    return pd.concat(out)[names]


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, query_block: int = 4096, row_block: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, the k best other rows.

    Components become floor(scale * x), whole numbers of any size; a score beyond 64 bits becomes the nearest long, and such scores
    count as equal where blocks are merged. Equal scores go by the smaller id. Null vectors, and those with null or non-finite components, take no part; of vectors of
    unequal length the missing components are 0. Rows that repeat an id are rows of their own, and a query leaves out just its own
    row. Other columns of `vectors` play no part. Fewer than k other rows give fewer results; an empty table gives none.
    """
    v = F.col(vector_col)
    whole = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = cut(vectors.where(whole & F.col(id_col).isNotNull()).select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: x.cast("double")).alias("v")))
    n = rows.count()
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    row_blocks, query_blocks = max(1, -(-n // row_block)), max(1, -(-queries.count() // query_block))
    dealt = lambda df, name, count: df.withColumn(name, F.pmod(F.xxhash64("row_id"), F.lit(count)).cast("int"))
    copied = lambda df, name, count: df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    left = copied(dealt(queries, "q", query_blocks), "b", row_blocks).groupBy("q", "b")
    right = copied(dealt(rows, "b", row_blocks), "q", query_blocks).groupBy("q", "b")
    best = left.cogroup(right).applyInPandas(lambda a, b: block_top_k(a, b, k, scale), "query_row long, query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
