"""Sort-and-pick operators: latest, best, round robin, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidara.session import cut, drop, large


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; the order must break all ties."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def round_robin(rows: DataFrame, group: str, order: list[Column], most: int) -> DataFrame:
    """Rows with `turn`, their place in their group, from 1 to `most`: all first rows come before all second ones."""
    return rows.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("turn") <= most)


def totals_before(rows: DataFrame, outer: str, inner: str, order: list[Column], sums: list[str]) -> DataFrame:
    """Rows with `<sum>_before` for each of `sums`: the total over all rows before, in order of (outer, inner, order).

    Rows are summed within each (outer, inner), these within each outer, and only the outer totals meet in one task; so `outer` must take few
    values and an (outer, inner) few rows. `order` breaks all ties; null values count as 0.
    """
    value = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    run = lambda c, w: F.coalesce(F.sum(c).over(until(w)), F.lit(0))
    own = Window.partitionBy(outer, inner).orderBy(*order)
    made = rows.withColumns({f"__{c}": value(c) for c in sums}).withColumns({f"__own_{c}": run(f"__{c}", own) for c in sums})
    parts = made.groupBy(outer, inner).agg(*(F.sum(f"__{c}").alias(f"__{c}") for c in sums))
    whole = parts.groupBy(outer).agg(*(F.sum(f"__{c}").alias(f"__{c}") for c in sums))
    whole = whole.select(outer, *(run(f"__{c}", Window.orderBy(outer)).alias(f"__far_{c}") for c in sums))
    parts = parts.select(outer, inner, *(run(f"__{c}", Window.partitionBy(outer).orderBy(inner)).alias(f"__near_{c}") for c in sums)).join(whole, outer)
    made = made.join(parts, [outer, inner]).withColumns({f"{c}_before": F.col(f"__own_{c}") + F.col(f"__near_{c}") + F.col(f"__far_{c}") for c in sums})
    return made.drop(*(f"__{kind}{c}" for c in sums for kind in ("", "own_", "near_", "far_")))


def failure_cap(documents: int) -> int:
    """How many failures end a run over so many documents. The numbers are fixed values."""
    return max(24, min(100, -(-documents // 8)))


def downloads(candidates: DataFrame, group: str, position: str, order: list[Column], documents: int, size: int, most: int = 48, failures: int = 5, block: int = 1000) -> DataFrame:
    """Candidates (group, position of the group, url, bytes, ok) that are attempted, with `turn`: round by round over the groups, each by its own order.

    A group gives `most` candidates at most and none after `failures` failed ones; a url that was had is passed over, as a url's outcome
    is the same each time. All ends when `documents` are had, or `size` bytes, or `failure_cap` failures. Groups are numbered by `position`.
    """
    rows = round_robin(candidates, group, order, most).withColumns({"failed": (~F.col("ok")).cast("int"), "had": F.col("ok").cast("int")})
    before = Window.partitionBy(group).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__f", F.coalesce(F.sum("failed").over(before), F.lit(0))).where(F.col("__f") < failures).drop("__f")
    first = Window.partitionBy("url").orderBy("turn", position)
    rows = rows.withColumn("__n", F.row_number().over(first)).where("NOT ok OR __n = 1").drop("__n")
    rows = rows.withColumns({"__block": F.floor(F.col(position) / block), "used": F.when(F.col("ok"), F.col("bytes")).otherwise(0)})
    rows = totals_before(rows, "turn", "__block", [F.col(position)], ["had", "used", "failed"])
    return rows.where((F.col("had_before") < documents) & (F.col("used_before") < size) & (F.col("failed_before") < failure_cap(documents))).drop("__block", "used", "had", "failed")


def within_budget(rows: DataFrame, group: str, order: list[str], size: str, budget: int, most: int) -> DataFrame:
    """(group, taken, failed, used): rows are taken in order while bytes and count last.

    A row larger than what is left fails and uses up one of the `most` places, but no bytes. As every row uses a place until
    the group is closed, its first `most` rows decide; a ranked filter keeps just them, and an ordered fold runs over their array. A null
    size counts as 0.
    """
    rows = round_robin(rows, group, [F.col(c) for c in order], most)
    start = F.struct(F.lit(0).cast("bigint").alias("taken"), F.lit(0).cast("bigint").alias("failed"), F.lit(0).cast("bigint").alias("used"))

    def step(s: Column, x: Column) -> Column:
        open_ = (s["taken"] + s["failed"] < most) & (s["used"] < budget)
        fits = open_ & (s["used"] + x["size"] <= budget)
        one = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
        return F.struct((s["taken"] + one(fits)).alias("taken"), (s["failed"] + one(open_ & ~fits)).alias("failed"), (s["used"] + F.when(fits, x["size"]).otherwise(F.lit(0).cast("bigint"))).alias("used"))

    listed = F.array_sort(F.collect_list(F.struct("turn", F.coalesce(F.col(size).cast("bigint"), F.lit(0).cast("bigint")).alias("size"))))
    return rows.groupBy(group).agg(F.aggregate(listed, start, step).alias("s")).select(group, "s.*")


def greedy_by_alias(rows: DataFrame, key: str, aliases: str, order: list[Column]) -> DataFrame:
    """The keys that a greedy pass keeps: rows are taken in order unless one of their aliases was taken before.

    In each round the rows that come first for every alias of theirs are kept, and rows that share an alias with a kept one go; so the
    rounds are as many as the longest chain of rows that hinge on each other. Keys are unique; `order` are columns that rise, and break
    all ties. Rows without aliases are kept.
    """
    ranked = rows.select(key, F.struct(*order).alias("__place"), F.array_distinct(F.filter(aliases, lambda x: x.isNotNull())).alias("__aliases"))
    kept = ranked.where(F.size("__aliases") == 0).select(key)
    left = cut(ranked.select(key, "__place", F.explode("__aliases").alias("__alias")))
    while not left.isEmpty():
        first = left.groupBy("__alias").agg(F.min_by(key, "__place").alias("__first"))
        said = cut(left.join(large(first), "__alias").groupBy(key).agg(F.bool_and(F.col(key) == F.col("__first")).alias("__won")))
        won = said.where("__won").select(key)
        kept = kept.union(won)
        taken = left.join(large(won), key, "left_semi").select("__alias").distinct()
        gone = left.join(large(taken), "__alias", "left_semi").select(key).distinct()
        rest = cut(left.join(large(gone), key, "left_anti"))
        drop(left)
        left = rest
    return kept
