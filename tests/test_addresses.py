"""Addresses of links against the standard library."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from evidara.functions import scalars as S

BASES = ["https://a.example/b/c/d?q=1#f", "https://a.example", "https://a.example/", "http://localhost:80/x/y"]
HREFS = ["g", "./g", "g/", "/g", "//g.example/h", "?y", "g?y", "#s", "g#s", ".", "./", "..", "../", "../g", "../..", "../../g", "../../../g", "/./g", "/../g", "g.", "..g", "./../g", "g/./h", "g/../h", "g?y/../x", "https://z.example/a/../b", "mailto:x@y", "x/y/../../z?a=/../b#c"]


def test_addresses_resolve_as_in_the_standard_library(spark):
    rows = spark.createDataFrame([(b, h) for b in BASES for h in HREFS], "b string, h string").withColumn("u", S.resolved_url(F.col("b"), F.col("h"))).collect()
    for r in rows:
        want = urljoin(r.b if "/" in r.b[8:] else f"{r.b}/", r.h)
        assert r.u == want or r.u.rstrip("/") == want.rstrip("/"), (r.b, r.h, r.u)
    none = spark.createDataFrame([("", "x"), (None, "x"), ("https://a.example/", None)], "b string, h string").select(S.resolved_url(F.col("b"), F.col("h")).alias("u")).collect()
    assert [r.u for r in none] == [None, None, None]


def test_only_safe_addresses_are_fetched(spark):
    urls = {"https://a.example/x": True, "HTTPS://A": True, "http://a.example": False, "http://localhost/x": True, "http://127.0.0.1:8": True, "http://localhost.example/": False, "http://[::1]/": True, "ftp://a": False, "": False}
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", S.is_fetchable(F.col("u")).alias("ok")).collect()
    assert {r.u: r.ok for r in rows} == urls
