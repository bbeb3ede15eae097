"""URL filters from association rules that Spark's FP-growth mines, DataFrame functions only.

A labelled page is a transaction of its URL's tokens and its label. Token combinations with enough support whose label
is `block` clearly more often than among all labelled pages are the rules. A rule is looked up by its rarest token and then compared in full.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.session import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = "label=block"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ? or #, A-Z lower-cased; empty without a ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? or #; empty without a ://."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens: labels of the host, words of the path, names in the query; digits are written as 0."""
    query = F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))
    words = lambda text, pattern, mark: F.transform(F.filter(F.split(F.regexp_replace(F.lower(text), "[0-9]+", "0"), pattern), lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    names = F.transform(F.filter(F.split(F.lower(query), "&"), lambda x: x != ""), lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)))
    return F.array_distinct(F.concat(words(host_of(url), r"\.", "host:"), words(path_of(url), "[^a-z0-9]+", "path:"), names))


def mined_rules(labelled: DataFrame, min_support: float, min_hits: int, min_lift: float, min_deviations: float) -> DataFrame:
    """(items, confidence, support, first): token combinations that imply `block`, and each one's rarest token.

    `labelled` has tokens and blocked. A combination counts from `min_support` of the transactions on, and from
    `min_hits` of them. Pruned are rules whose confidence is below `min_lift` times the share of blocked pages (or below the middle
    between that share and 1, if that is less), and rules whose hits are less than `min_deviations` standard deviations above those
    that the share alone would give.
    """
    whole = labelled.agg(F.count("*").alias("n"), F.avg(F.col("blocked").cast("double")).alias("share")).first()
    pages, share = max(1, whole["n"]), whole["share"] or 0.0
    label = F.when(F.col("blocked"), F.array(F.lit(BLOCK))).otherwise(F.array())
    baskets = labelled.select(F.concat("tokens", label).alias("items")).where(F.size("items") > 0)
    sets = cut(FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, min_hits / pages))).fit(baskets).freqItemsets.withColumn("items", F.array_sort("items")))
    with_label = sets.where(F.array_contains("items", BLOCK) & (F.size("items") > 1)).select(F.array_remove("items", BLOCK).alias("items"), F.col("freq").alias("hits"))
    rules = with_label.join(sets, "items").select("items", "hits", "freq", (F.col("hits") / F.col("freq")).alias("confidence"), (F.col("hits") / pages).alias("support"))
    above = F.col("hits") - F.col("freq") * share
    sure = above * above >= min_deviations**2 * share * (1 - share) * F.col("freq")
    rules = rules.where(f"hits >= {max(min_hits, min_support * pages)}").where((F.col("confidence") >= min(min_lift * share, (1 + share) / 2)) & (above > 0) & sure).drop("hits", "freq")
    one = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("item"), "freq")
    rarest = rules.select("items", F.explode("items").alias("item")).join(one, "item").groupBy("items").agg(F.min_by("item", F.struct("freq", "item")).alias("first"))
    return cut(rules.join(rarest, "items"))


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, confidence, n_rules) for each distinct url of (url, tokens) that a rule matches: the best confidence."""
    found = urls.select("url", "tokens", F.explode("tokens").alias("first")).join(rules, "first").where(F.size(F.array_except("items", "tokens")) == 0)
    return found.groupBy("url").agg(F.max("confidence").alias("confidence"), F.count("*").alias("n_rules"))


def url_verdicts(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], min_support: float = 0.002, min_hits: int = 25, min_lift: float = 1.5, min_deviations: float = 4.0, id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id") -> DataFrame:
    """(id, host, path, rule, verdict, confidence, n_rules) per row of `pages`.

    `rules` are (block or allow, host/path): such a rule fits its host and all subdomains when the path starts with the
    rule's; the longest decides. Other pages are blocked if a mined rule matches, else allowed. A page is labelled by
    the row of `labels` with its id; it is blocked there if quality is 0 or toxic is 1 in any such row; rows with
    neither don't count. A null url has empty host, path and tokens. Rows with the same id are judged one by one; urls may have any
    length; other columns of `pages` play no part. Without labels nothing is mined; an empty table gives an empty result.
    """
    said = labels.groupBy(F.col(label_id).alias("__id")).agg(F.max((F.coalesce(F.col("quality") == 0, F.lit(False))) | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("blocked"), F.count(F.coalesce("quality", "toxic")).alias("__n")).where("__n > 0")
    url = F.col("url")
    rows = pages.select(F.col(id_col), F.col(url_col).alias("url")).withColumns({"host": host_of(url), "path": path_of(url)})
    fixed = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(slash + path))
        fixed, verdict = F.when(fits, F.lit(rule)).otherwise(fixed), F.when(fits, F.lit(kind)).otherwise(verdict)
    rows = rows.withColumns({"rule": fixed, "said": verdict})
    learned = mined_rules(rows.join(said, F.col(id_col) == F.col("__id")).select(tokens_of(url).alias("tokens"), "blocked"), min_support, min_hits, min_lift, min_deviations)
    hits = matched(rows.where("rule IS NULL AND url IS NOT NULL").select("url").distinct().withColumn("tokens", tokens_of(url)), learned)
    judged = F.coalesce("said", F.when(F.col("n_rules") > 0, "block").otherwise("allow"))
    # pages that need no lookup are dealt by their id instead of meeting at a null
    free = F.col("rule").isNull() & F.col("url").isNotNull()
    dealt = F.when(free, F.col("url")).otherwise(F.xxhash64(id_col, "url").cast("string"))
    keys = {"__url": dealt, "__free": free}
    hits = hits.withColumnRenamed("url", "__url").withColumn("__free", F.lit(True))
    return rows.withColumns(keys).join(hits, ["__url", "__free"], "left").select(id_col, "host", "path", "rule", judged.alias("verdict"), "confidence", F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_rules"))
