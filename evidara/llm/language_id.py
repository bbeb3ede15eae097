"""Language ID by Bayesian fusion of a text likelihood with a declared language, an address suffix and host priors.

    ln P(language | all) = ln prior(language | host) + ln P(declared | language) + ln P(suffix | language) + tempered ln P(text | language)

The text likelihood is a naive Bayes over hashed byte trigrams, learned from all labelled texts by grouped sums. The
tables P(declared | language) and P(suffix | language) and the host priors come from grouped sums of the text-only
posteriors over all rows. A host's prior is smoothed towards its domain's, that towards the whole table's; a row's own share is
taken out of the counts that judge it. Text that no language explains better than chance is `und` and is rejected.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidara.llm import textkit as T
from evidara.session import bounded_batches, cut

BUCKETS = 1 << 16
UND = "und"
#: Languages whose counts a task holds at once (half a megabyte each).
HELD = 64
#: Places of a long text that are worked on at once.
WINDOW = 1 << 19
#: Hosts up to which their priors are broadcast; beyond, rows are joined with them by host.
BROADCAST_HOSTS = 100_000
#: Markup that holds no text of the page, then any tag.
HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>|<[^>]*>"


def trigrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of each byte trigram inside a text, A-Z lower-cased; bytes that are neither letters nor beyond ASCII count as one sign."""
    kind = np.where(T.IS_MARK, 32, T.LOWER).astype(np.uint8)
    kind[48:58] = 32
    b = kind[data].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = (((b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA6B)) ^ (b[2:] * np.uint32(0xC2B2AE35))) * np.uint32(0x27D4EB2F)) >> np.uint32(16)
    good = np.ones(len(x), bool)
    inner = at[1:-1]
    for back in (1, 2):
        cutoff = inner - back
        good[cutoff[(cutoff >= 0) & (cutoff < len(x))]] = False
    # a trigram of signs only says nothing
    good &= ~((b[:-2] == 32) & (b[1:-1] == 32)) & ~((b[1:-1] == 32) & (b[2:] == 32))
    where = np.flatnonzero(good)
    return x[where].astype(np.int64), np.searchsorted(at, where, "right") - 1


def bounded_trigrams(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """`trigrams` of a slice; those of a longer text come in parts of WINDOW places."""
    if len(at) > 2 or len(data) <= 2 * WINDOW:
        yield trigrams(data, at)
        return
    for first in range(0, len(data) - 2, WINDOW):
        part = data[first : first + WINDOW + 2]
        yield trigrams(part, np.array([0, len(part)]))


#: Three-letter codes of languages that have a two-letter code (both forms of ISO 639-2).
SAME = dict(
    ara="ar", bul="bg", ces="cs", chi="zh", cze="cs", dan="da", deu="de", dut="nl", ell="el", eng="en", est="et", fas="fa", fin="fi", fra="fr", fre="fr", ger="de", gre="el", heb="he", hin="hi", hrv="hr", hun="hu",
    ind="id", ita="it", jpn="ja", kor="ko", lav="lv", lit="lt", may="ms", msa="ms", nld="nl", nor="no", per="fa", pol="pl", por="pt", ron="ro", rum="ro", rus="ru", slk="sk", slo="sk", slv="sl", spa="es", srp="sr",
    swe="sv", tha="th", tur="tr", ukr="uk", vie="vi", zho="zh",
)


def label(x: Column) -> Column:
    """The language that a label begins with: two or three letters a-z which no letter follows; else null."""
    tag = F.nullif(F.regexp_extract(F.lower(F.trim(x)), "^([a-z]{2,3})(?![a-z])", 1), F.lit(""))
    return F.coalesce(F.element_at(F.create_map(*(F.lit(v) for pair in SAME.items() for v in pair)), tag), tag)


def learned(labelled: DataFrame, text_col: str, lang_col: str, most: int) -> tuple[list[str], np.ndarray]:
    """(languages, ln P(bucket | language)) from all rows with a label; a language is known if any text of it has a trigram.

    The table has one row per language and BUCKETS columns. If there are more than `most` languages, those with the most rows count,
    then by name; what others declare counts as unknown.
    """
    rows = labelled.where(F.col(text_col).isNotNull()).select(label(F.col(lang_col)).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL")
    counted_langs = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most + 1).collect()
    if len(counted_langs) > most:
        rows = rows.where(F.col("lang").isin([r["lang"] for r in counted_langs[:most]]))

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for part, data, at in T.slices(batches, most=WINDOW):
            langs = part.column(0).to_pylist()
            kinds = sorted(set(langs))
            place = np.array([kinds.index(v) for v in langs])
            for x, text in bounded_trigrams(data, at):
                own = place[text]
                parts = np.split(x[np.argsort(own, kind="stable")], np.cumsum(np.bincount(own, minlength=len(kinds)))[:-1])
                for k, v in zip(kinds, parts, strict=True):
                    if k not in total:
                        if len(total) >= HELD:
                            yield from counted(total)
                            total.clear()
                        total[k] = np.zeros(BUCKETS, np.int64)
                    total[k] += np.bincount(v, minlength=BUCKETS)
        yield from counted(total)

    def counted(total):
        for k, v in total.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(v[at])], ["lang", "bucket", "n"])

    counts = rows.mapInArrow(T.tidied(run), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(counts["lang"]))
    table = np.zeros((len(langs), BUCKETS))
    if langs:
        table[counts["lang"].map(langs.index).to_numpy(), counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    # a bucket's share is backed by its share over all languages
    table += 0.5 * (table.sum(0) + 0.01) / max(1.0, table.sum() + 0.01 * BUCKETS) * BUCKETS
    return langs, np.log(table / table.sum(1, keepdims=True)) if langs else table


def text_scores(spark: SparkSession, table: np.ndarray) -> Callable[[Column], Column]:
    """A function of a text column: (n_grams, ll), where ll is ln P(text | language) of each language, then of `und`: chance.

    Only the texts go to Python and only the scores come back; a row's other columns stay where they are.
    """
    model = spark.sparkContext.broadcast(table.astype(np.float32))
    chance = -math.log(BUCKETS)  # all buckets alike

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = model.value
        for column in columns:
            counts, scores = [np.zeros(0, np.int64)], [np.zeros(0)]
            for _, data, at in T.slices([pa.RecordBatch.from_arrays([column], ["text"])], most=WINDOW):
                texts = len(at) - 1
                n, ll = np.zeros(texts, np.int64), np.zeros((texts, len(table) + 1))
                for x, text in bounded_trigrams(data, at):
                    n += np.bincount(text, minlength=texts)
                    for k, row in enumerate(table):
                        ll[:, k] += np.bincount(text, row[x], texts)
                ll[:, -1] = n * chance
                counts.append(n)
                scores.append(ll.ravel())
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(counts)), T.lists(np.concatenate(scores), np.full(len(column), len(table) + 1))], ["n_grams", "ll"])

    return F.arrow_udf(score, "n_grams long, ll array<double>")


def softmax(x: Column) -> Column:
    top = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - top))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def array_sums(name: str, size: int) -> Column:
    """An aggregate: the sums of an array column, place by place."""
    return F.array(*(F.sum(F.col(name)[k]) for k in range(size)))


def code_sums(groups: DataFrame, name: str, size: int) -> DataFrame:
    """(name, name_p): the sums of p over all rows with the same code, a row for each known language and two more at most."""
    return groups.groupBy(name).agg(array_sums("p", size).alias(f"{name}_p"))


def code(x: Column, langs: list[str]) -> Column:
    """The language that a declaration begins with if it's known, else '' for none and '?' for others."""
    named = label(x)
    return F.when(F.trim(F.coalesce(x, F.lit(""))) == "", "").when(named.isin(langs), named).otherwise("?") if langs else F.lit("")


def identify(rows: DataFrame, labelled: DataFrame, id_col: str, text: Column, declared: Column, suffix: Column, host: Column, domain: Column, keep: list[str] | None = None, text_col: str = "text", lang_col: str = "lang", temper: float = 60.0, prior_rows: float = 20.0, least: float = 0.5, most_languages: int = 150) -> DataFrame:
    """(id, lang, probability, text_lang, declared, n_grams, accepted, and the columns `keep` of `rows`) per row of `rows`.

    A text's evidence counts as that of at most `temper` trigrams, as neighbours aren't independent. `lang` is `und` where chance explains
    the text better than every language does, or where it has no trigram. Such rows aren't accepted, nor those whose
    best language has less than `least`. Null text is empty, null declarations and suffixes are none, a null host is ''. Labels and declarations
    count by their first subtag of two or three letters; at most `most_languages` languages are known. Without labelled rows every row is `und`. Of equal probabilities the language that comes first by name
    wins. Rows with the same id are judged one by one; other columns than those named play no part; texts may have any length;
    an empty table gives an empty result.

    The texts are read twice: for the grouped sums, to which no text is carried, and for the verdicts, which are joined with sums only.
    """
    bounded_batches(rows.sparkSession)
    langs, table = learned(labelled, text_col, lang_col, most_languages)
    size = len(langs) + 1
    keep = keep or []
    facts = [code(declared, langs).alias("declared"), code(suffix, langs).alias("suffix"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(domain, F.lit("")).alias("domain")]
    score = text_scores(rows.sparkSession, table)

    def scored(*columns: Column) -> DataFrame:
        made = rows.select(*columns, *facts, score(text).alias("__s")).select("*", "__s.n_grams", "__s.ll").drop("__s")
        made = made.withColumn("ll", F.transform("ll", lambda v: v * F.least(F.lit(1.0), temper / F.greatest(F.col("n_grams"), F.lit(1)))))
        return made.withColumn("p", F.when(F.col("n_grams") > 0, softmax(F.col("ll"))).otherwise(F.array(*[F.lit(0.0)] * size)))

    # grouped sums; the tables of codes have at most languages + 2 rows
    groups = cut(scored().groupBy("host", "domain", "declared", "suffix").agg(array_sums("p", size).alias("p"), F.count("*").alias("n")))
    total = groups.agg(array_sums("p", size).alias("p"), F.sum("n").alias("n")).first()
    all_p, all_n = F.array(*(F.lit(float(x or 0)) for x in total["p"])), F.lit(float(total["n"] or 0))
    declarations, suffixes = (F.broadcast(code_sums(groups, name, size)) for name in ("declared", "suffix"))
    hosts = groups.groupBy("host", "domain").agg(array_sums("p", size).alias("host_p"), F.sum("n").alias("host_n"))
    domains = hosts.groupBy("domain").agg(array_sums("host_p", size).alias("domain_p"), F.sum("host_n").alias("domain_n"))
    priors = cut(hosts.join(domains, "domain"))
    if priors.count() <= BROADCAST_HOSTS:
        priors = F.broadcast(priors)
    judged = scored(F.col(id_col).alias("__id"), *(F.col(c).alias(f"__keep_{c}") for c in keep))
    joined = judged.join(declarations, "declared").join(suffixes, "suffix").join(priors, ["host", "domain"])
    own, m = F.col("p"), prior_rows
    less = lambda total: F.zip_with(total, own, lambda a, b: F.greatest(a - b, F.lit(0.0)))
    base = F.transform(less(all_p), lambda v: (v + 0.5) / (all_n + 0.5 * size))
    of_domain = F.zip_with(less(F.col("domain_p")), base, lambda v, b: (v + m * b) / (F.col("domain_n") + m))
    prior = F.zip_with(less(F.col("host_p")), of_domain, lambda v, b: (v + m * b) / (F.col("host_n") + m))
    told = lambda name: F.zip_with(less(F.col(f"{name}_p")), less(all_p), lambda v, t: (v + 0.5) / (t + 0.5 * (size + 1)))
    sum_ln = lambda a, b: F.zip_with(a, b, lambda x, y: x + F.log(y))
    joined = joined.withColumn("prior", prior).withColumn("post", softmax(sum_ln(sum_ln(sum_ln(F.col("ll"), F.col("prior")), told("declared")), told("suffix"))))
    names = F.array(*(F.lit(x) for x in [*langs, UND]))
    name_of = lambda x: F.when(F.col("n_grams") == 0, UND).otherwise(F.element_at(names, F.array_position(x, F.array_max(x)).cast("int")))
    probability = F.when(F.col("n_grams") == 0, 0.0).otherwise(F.array_max("post"))
    out = joined.select(F.col("__id").alias(id_col), name_of(F.col("post")).alias("lang"), probability.alias("probability"), name_of(F.col("p")).alias("text_lang"), "declared", "n_grams", *(F.col(f"__keep_{c}").alias(c) for c in keep))
    return out.withColumn("accepted", (F.col("lang") != UND) & (F.col("probability") >= least))


def page_columns(url: Column, html: Column) -> dict[str, Column]:
    """What `identify` needs of web pages: visible text, declared language, address suffix, host and domain."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#:]*)", 1))
    code_in_path = F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*/([a-zA-Z]{2,3})(?:[-_/?#]|$)", 1)
    country = F.regexp_extract(host, r"\.([a-z]{2})$", 1)
    return {
        "text": F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " "),
        "declared": F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})(?![a-z])", 1),
        "suffix": F.when(code_in_path != "", code_in_path).otherwise(country),
        "host": host,
        "domain": F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1),
    }

