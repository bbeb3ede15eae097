"""Near-duplicate documents by MinHash with tensored banding, each link confirmed on the full shingle sets.

Two collections of `tables` keys, each key made of `rows` minimum hashes, give tables * tables table keys by pairing a
key of the first with one of the second: 2 * tables * rows minimum hashes do the work of tables**2 * 2 * rows. Two sets
with similarity s meet in a table with chance (1 - (1 - s**rows)**tables)**2; at 0.8 with rows = 2, tables = 10 that is
0.99993, at 0.85 0.999995.

A table key is shared only if both keys of which it is made are, so documents are first dealt by the 2 * tables single keys, and
pairs are formed of shared ones only. Documents with one shingle set are one node. In a bucket every node is tested against one pivot, the node that shares
most buckets with others; nodes that end in one component need no further test. Nodes of a bucket that are still in different
components meet again by an exact prefix filter: sets are put in one global order, rare shingles first, and only pairs that share
a shingle early enough to reach the similarity at all are tested. So a large group of near copies isn't paired out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidara.llm import textkit as T
from evidara.operators.graph import connected_components
from evidara.session import bounded_batches, cut, drop, freed_shuffles, likely

#: Cells of the count by which shingles are ordered.
SKETCH = 1 << 18


def shingles(data: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's shingles of k lower-cased words: (hashes, each text's first, count).

    A text with fewer words has one shingle, the whole sequence; a text without words has none.
    """
    w = T.Words(data, at)
    h = w.hashes(lower=True)
    x, first_word = w.windows(h, k)
    text = w.text[first_word]
    short = np.flatnonzero((w.count > 0) & (w.count < k))
    if len(short):
        whole = w.count[short].astype(T.U)
        for i in range(k - 1):
            more = w.count[short] > i
            whole[more] = (whole[more] + h[w.first[short][more] + i]) * T._STEP
        x, text = np.concatenate([x, T.mix(whole)]), np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        x, text = x[order], text[order]
    per = np.bincount(text, minlength=len(at) - 1)
    edge = np.concatenate([[0], np.cumsum(per)])
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if b - a > 1:
            x[a:b].sort()
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (text[1:] != text[:-1])
    x, text = x[new], text[new]
    per = np.bincount(text, minlength=len(at) - 1)
    return x, np.concatenate([[0], np.cumsum(per)])[:-1], per


def minimum_keys(x: np.ndarray, first: np.ndarray, per: np.ndarray, tables: int, rows: int, seed: int) -> np.ndarray:
    """For each set (all non-empty), `tables` keys of `rows` minimum hashes each."""
    factors = np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, (2, tables, rows), dtype=np.uint64) * T.U(2) + T.U(1)
    out = np.empty((len(per), tables), T.U)
    for i in range(tables):
        key = np.full(len(per), T.U(i + 1))
        for j in range(rows):
            key = T.mix(key * T._STEP + np.minimum.reduceat((x ^ factors[1, i, j]) * factors[0, i, j], first))
        out[:, i] = key
    return out


def signs(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two hashes of each set (all non-empty): sums of two mixers over its shingles."""
    return np.stack([np.add.reduceat(T.mix(x), first), np.add.reduceat(T.mix(x ^ T._STEP), first)])


def sketches(docs: DataFrame, k: int, tables: int, rows: int, seed: int) -> DataFrame:
    """(node, n_shingles, s1, s2, a, b) per row of (node, text): set size, two hashes of the set, both key collections."""

    def run(batches):
        for some, data, at in T.slices(batches):
            x, first, per = shingles(data, at, k)
            full = np.flatnonzero(per)
            signed, keys = np.zeros((2, len(per)), T.U), [np.zeros((0, tables), T.U)] * 2
            if len(full):
                begin = first[full]
                signed[:, full] = signs(x, begin)
                keys = [minimum_keys(x, begin, per[full], tables, rows, seed + c) for c in range(2)]
            made = [T.lists(T.signed(np.ascontiguousarray(keys[c]).ravel()), np.where(per > 0, tables, 0)) for c in range(2)]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(per.astype(np.int64)), pa.array(T.signed(signed[0].copy())), pa.array(T.signed(signed[1].copy())), *made], ["node", "n_shingles", "s1", "s2", "a", "b"])

    return docs.mapInArrow(T.tidied(run), "node long, n_shingles long, s1 long, s2 long, a array<long>, b array<long>")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """(node, set) for the rows of (node, s1, s2, text) whose text has the set that s1 and s2 name."""

    def run(batches):
        for some, data, at in T.slices(batches):
            x, first, per = shingles(data, at, k)
            full = np.flatnonzero(per)
            if not len(full):
                continue
            own = T.signed(signs(x, first[full]))
            right = np.zeros(len(per), bool)
            right[full] = (own[0] == some.column(1).to_numpy()[full]) & (own[1] == some.column(2).to_numpy()[full])
            keep = pa.array(right)
            yield pa.RecordBatch.from_arrays([some.column(0).filter(keep), T.lists(T.signed(x), per).filter(keep)], ["node", "set"])

    return docs.select("node", "s1", "s2", "text").mapInArrow(T.tidied(run), "node long, set array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets reach the similarity."""
    both = F.size(F.array_intersect("su", "sv"))
    # sets are long: those of no pair stay where they are
    sets = likely(sets, pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct(), "node")
    joined = pairs.join(sets.select(F.col("node").alias("u"), F.col("set").alias("su")), "u").join(sets.select(F.col("node").alias("v"), F.col("set").alias("sv")), "v")
    return joined.where(100 * both >= percent * (F.size("su") + F.size("sv") - both)).select("u", "v")


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(token, place, n, rep, component) for the first shingles of each set of (rep, component, set), the rarest first.

    Rarity is the count of a shingle's cell among SKETCH cells, a broadcast of that fixed size; any order common to all sets is exact.
    """
    cell = F.pmod(F.col("x"), F.lit(SKETCH)).cast("int")
    with freed_shuffles(sets.sparkSession):
        counts = sets.select(F.explode("set").alias("x")).groupBy(cell.alias("cell")).agg(F.least(F.count("*"), F.lit(2**31 - 1)).cast("int").alias("n")).toArrow()
    sketch = np.zeros(SKETCH, np.int32)
    sketch[counts["cell"].to_numpy()] = counts["n"].to_numpy()
    cells = sets.sparkSession.sparkContext.broadcast(sketch)

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            at, x = lists.offsets.to_numpy(), lists.flatten().to_numpy()
            at = at - at[0]
            out: list[list[np.ndarray]] = [[], [], [], []]
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                n = b - a
                top = n - -(-percent * n // 100) + 1
                own = x[a:b]
                order = np.lexsort((own, cells.value[own % SKETCH]))[:top]
                for column, values in zip(out, (own[order], np.arange(top, dtype=np.int32), np.full(top, n), np.full(top, i)), strict=True):
                    column.append(values)
            if out[0]:
                token, place, n, row = (np.concatenate(c) for c in out)
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(place), pa.array(n), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))], ["token", "place", "n", "rep", "component"])

    return sets.select("rep", "component", "set").mapInArrow(T.tidied(run), "token long, place int, n long, rep long, component long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, tables: int = 10, rows: int = 2, seed: int = 11) -> DataFrame:
    """(id, n_shingles, component_id) per row of `docs`: component_id is the smallest id linked with it, itself included.

    Links: 100 * intersection >= percent * union of the distinct shingles of k lower-cased words. Ids are integers and
    not null. Texts without words, null ones included, have no shingles and no links. Rows that repeat an id are linked with each
    other, whatever their texts; n_shingles is each row's own. Texts may have any length; other columns of `docs` play no part. An
    empty table gives an empty result. Two sets are the same if their sizes and two 64-bit hashes are.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    made = cut(sketches(texts.select(F.col("id").alias("node"), "text"), k, tables, rows, seed).withColumnRenamed("node", "id"))
    sign = ["s1", "s2", "n_shingles"]
    classes = made.where("n_shingles > 0").groupBy(*sign).agg(F.min("id").alias("id"), F.first("a").alias("a"), F.first("b").alias("b"))
    classes = cut(classes.withColumn("rep", F.monotonically_increasing_id()))
    signed = cut(made.select("id", *sign))
    drop(made)
    # a table key is shared only if both keys of which it is made are
    single = classes.select("rep", F.explode(F.concat("a", "b")).alias("key"))
    shared = cut(single.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"))
    mine = single.join(shared, "key").groupBy("rep").agg(F.collect_set("key").alias("mine"))
    left = classes.join(mine, "rep").select("rep", F.col("n_shingles").alias("n"), F.array_intersect("a", "mine").alias("a"), F.array_intersect("b", "mine").alias("b"))
    pairs = F.explode(F.flatten(F.transform("a", lambda x: F.transform(F.col("b"), lambda y: F.xxhash64(x, y)))))
    keys = cut(left.select("rep", "n", pairs.alias("key")))
    sizes = cut(keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
    live = cut(keys.join(sizes, "key"))
    named = cut(classes.select("rep", "id", *sign))
    drop(shared, keys, sizes, classes)
    classes = named
    # the node of most company is a bucket's pivot: the original rather than one of its variants
    company = cut(live.groupBy("rep", "n").agg(F.sum("c").alias("company")))
    pivots = live.join(company, ["rep", "n"]).groupBy("key").agg(F.max(F.struct("company", -F.col("rep"), "n")).alias("p"))
    pivots = cut(pivots.select("key", (-F.col("p.col2")).alias("pivot"), F.col("p.n").alias("np")))
    star = live.join(pivots, "key").where(f"rep <> pivot AND 100 * least(n, np) >= {percent} * greatest(n, np)")
    star = cut(star.select(F.least("rep", "pivot").alias("u"), F.greatest("rep", "pivot").alias("v")).distinct())
    named = cut(company.select("rep").join(classes.select("rep", "id", "s1", "s2"), "rep"))
    found = likely(texts, named, "id").join(named, "id").dropDuplicates(["id", "rep", "s1", "s2", "text"])
    sets = cut(shingle_sets(found.withColumnRenamed("rep", "node"), k))
    drop(company, pivots, named)
    edges = cut(confirmed(star, sets, percent))
    known = connected_components(edges).withColumnRenamed("node", "rep")
    now = cut(live.select("key", "rep").join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    split = cut(now.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most").select("key"))
    open_nodes = cut(now.join(split, "key").select("rep", "component").distinct())
    drop(live, now, split)
    first = cut(prefixes(likely(sets.withColumnRenamed("node", "rep"), open_nodes, "rep").join(open_nodes, "rep"), percent))
    drop(open_nodes)
    # of a token's nodes the most frequent component pairs with the others only, not within itself
    per = cut(first.groupBy("token", "component").agg(F.count("*").alias("c")))
    apart = cut(per.groupBy("token").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("c", "component")).alias("main")).where("parts > 1").select("token", "main"))
    every = first
    first = cut(every.join(apart, "token").withColumn("main", F.col("component") == F.col("main")))
    drop(every, per, apart)
    other = first.select("token", *(F.col(c).alias(f"{c}2") for c in ("place", "n", "rep", "component", "main")))
    # the smaller set of a pair has the shared shingle early: what is left after it must do for the similarity with a set as large as itself
    early = first.where(f"{100 + percent} * (n - place) >= {2 * percent} * n")
    reach = f"component <> component2 AND 100 * least(n, n2) >= {percent} * greatest(n, n2) AND {100 + percent} * least(n - place, n2 - place2) >= {percent} * (n + n2)"
    pairs = early.where("NOT main").join(other, "token").union(early.where("main").join(other.where("NOT main2"), "token"))
    pairs = pairs.where(reach).select(F.least("rep", "rep2").alias("u"), F.greatest("rep", "rep2").alias("v")).distinct()
    pairs = cut(pairs.join(star, ["u", "v"], "left_anti"))
    edges = edges.union(cut(confirmed(pairs, sets, percent)))
    drop(first, pairs, star, sets)
    # rows of one id are linked
    again = cut(signed.groupBy("id").agg(F.count("*").alias("c")).where("c > 1").select("id"))
    repeated = not again.isEmpty()
    if repeated:
        own = signed.where("n_shingles > 0").join(again, "id").join(classes.select(*sign, "rep"), sign).select("id", "rep").distinct()
        edges = edges.union(own.join(own.groupBy("id").agg(F.min("rep").alias("u")), "id").where("u <> rep").select("u", F.col("rep").alias("v")))
    known = connected_components(edges).select(F.col("node").alias("rep"), "component")
    known = classes.select(*sign, "rep", "id").join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    named = cut(known.groupBy("component").agg(F.min("id").alias("component_id")))
    found = known.join(named, "component").select(*sign, "component_id")
    out = signed.join(found, sign, "left").select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
    if repeated:
        least = out.join(again, "id").groupBy("id").agg(F.min("component_id").alias("__least"))
        out = out.join(least, "id", "left").select("id", "n_shingles", F.coalesce("__least", "component_id").alias("component_id"))
    kind = docs.schema[id_col].dataType
    return out.select(F.col("id").cast(kind).alias(id_col), "n_shingles", F.col("component_id").cast(kind).alias("component_id"))
