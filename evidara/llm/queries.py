"""The queries of this subpackage, with the parameters that production uses, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidara.llm import byte_bpe, centroids, cotraining, fill_middle, gated_lm, language_id, near_duplicates, packing, quality_rules, repeats, threshold_search, toxicity, url_filters

#: The public tokenizers' vocabulary files.
WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under a gated recurrent model and under smoothed unigram counts."""
    return gated_lm.lm_scores(table(spark, sf_dir, "documents"))


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every document and the verdict of the cross-document line rules."""
    return quality_rules.line_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words", F.size("removed_lines").alias("n_removed_lines")
    )


def op3_suffix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when all strings of 400 bytes found twice or more are removed, and its bytes in repeated passages of these
    or of more than 50 words."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), words=51, cut_words=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_bytes")


def op4_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on shingles of four words."""
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), k=4)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op5_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces packed into sequences of 4096 tokens."""
    parts = packing.pieces(table(spark, sf_dir, "documents"), WORD_BPE)
    return packing.pack(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def metadata_columns() -> list:
    """What is known of a document besides its text's content: source, language, and the sizes of text and lines."""
    size = F.coalesce(F.col("n_chars"), F.lit(0))
    lines = F.coalesce(F.length("text") - F.length(F.translate("text", "\n", "")), F.lit(0))
    log = lambda x: F.floor(F.log2(x + 1.0) * 2)
    return [F.col("source"), F.col("lang"), log(size), log(lines), log(size / (lines + 1))]


def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, from its text and its metadata."""
    return cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), metadata_columns())


def op7_threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors for every 50th vector."""
    return threshold_search.top_k(table(spark, sf_dir, "embeddings"))


def op8_folded_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's byte-level ids and the bytes that they decode to, as hashes."""
    return byte_bpe.encode_texts(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)


def op9_evidence_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page by its text, its markup, its address and its host."""
    columns = language_id.page_columns(F.col("url"), F.col("html"))
    return language_id.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"), "page_id", **columns)


#: Fixed rules on host and path.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op10_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL."""
    return url_filters.url_verdicts(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after ten rounds of Lloyd's algorithm in integers."""
    return centroids.lloyd(table(spark, sf_dir, "embeddings"))


def op12_toxic_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document by a lexicon learned from the labels."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into three parts and put into another order, as hashes of the output and of the text rebuilt from it."""
    return fill_middle.fill_middle(table(spark, sf_dir, "documents"), digests=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_gated_lm": op1_gated_lm,
    "op2_line_frequency": op2_line_frequency,
    "op3_suffix_intervals": op3_suffix_intervals,
    "op4_tensored_minhash": op4_tensored_minhash,
    "op5_pattern_packing": op5_pattern_packing,
    "op6_cotraining": op6_cotraining,
    "op7_threshold_search": op7_threshold_search,
    "op8_folded_merges": op8_folded_merges,
    "op9_evidence_fusion": op9_evidence_fusion,
    "op10_association_rules": op10_association_rules,
    "op11_centroids": op11_centroids,
    "op12_toxic_lexicon": op12_toxic_lexicon,
    "op13_fill_middle": op13_fill_middle,
}

_WORDS = r"[^\x20\x09-\x0D]+"



def lloyd_sql(k: int = 8, rounds: int = 10) -> str:
    """Lloyd's algorithm with a few common tables a round."""
    assign = """a{i} AS (SELECT r, min_by(c, (d, c)) AS c, min(d) AS d FROM (SELECT r, c.c AS c, list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{i} c) GROUP BY r)"""
    move = """s{i} AS (SELECT c, g, sum(v.e[g])::HUGEINT AS s, count(*) AS n FROM a{i} JOIN v USING (r), range(1, 65) t(g) GROUP BY c, g),
m{i} AS (SELECT c, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY g) AS e FROM s{i} GROUP BY c),
c{j} AS (SELECT c, coalesce(m{i}.e, c{i}.e) AS e FROM c{i} LEFT JOIN m{i} USING (c))"""
    steps = ",\n".join(f"{assign.format(i=i)},\n{move.format(i=i, j=i + 1)}" for i in range(rounds))
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding AS x, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS c, e FROM v QUALIFY c < {k}),
{steps},
{assign.format(i=rounds)},
t AS (SELECT vec_id, c, d, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia FROM a{rounds} JOIN v USING (r))
SELECT vec_id, c::INTEGER AS cluster, d AS distance, cluster_inertia, inertia, sha256(array_to_string(e, ',')) AS centroid_sha256 FROM t JOIN c{rounds} USING (c)"""


ORACLE_SQL: dict[str, str] = {
    "op11_centroids": lloyd_sql(),
    "op13_fill_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
h AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS x, ('0x' || h[9:16])::BIGINT % (n + 1) AS y, ('0x' || h[17:24])::BIGINT % 100 AS p, ('0x' || h[25:32])::BIGINT % 100 AS q FROM d),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR p >= 90 THEN 'plain' WHEN q < 20 THEN 'spm' ELSE 'psm' END AS form, least(x, y) AS a, greatest(x, y) AS b FROM h),
s AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM s""",
    "op7_threshold_search": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM k WHERE rank <= 5""",
    "op4_tensored_minhash": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b USING (g) GROUP BY 1, 2),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON e.u = r.v),
c AS (SELECT u, min(v) AS c FROM r GROUP BY u)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.u = doc_id""",
    "op2_line_frequency": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM (SELECT r, regexp_extract_all(t, '{_WORDS}') AS ws FROM d)),
ww AS (SELECT r, i, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, word, w2, w3) AS n FROM ww WHERE w3 IS NOT NULL) WHERE n >= 2),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY r),
base AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY r),
l AS (SELECT r, host, h, line, array_to_string(ws, ' ') AS norm, len(ws) AS n, i FROM (
  SELECT r, host, h, line, i, regexp_extract_all(lower_az, '{_WORDS}') AS ws FROM (
    SELECT r, host, md5(t) AS h, i, line, translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM (
      SELECT r, host, t, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT r, host, t, string_split(t, chr(10)) AS ls FROM d))))
  WHERE len(ws) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM l GROUP BY r),
f AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT h) AS k FROM l GROUP BY host, norm) JOIN (SELECT host, count(DISTINCT md5(t)) AS k_host FROM d GROUP BY host) USING (host) WHERE k > 20 AND (k > 0.02 * k_host OR k > 10000)),
gone AS (SELECT r, sum(n) AS n, count(*) AS lines FROM l JOIN f USING (host, norm) GROUP BY r),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
  coalesce(covered.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS removed_words, coalesce(gone.lines, 0) AS n_removed_lines
  FROM d LEFT JOIN base USING (r) LEFT JOIN covered USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND removed_words <= 0.5 * n_words AS kept,
  removed_words::BIGINT AS removed_words, n_removed_lines::INTEGER AS n_removed_lines FROM m""",
}
