"""Evidence fusion over pages against plain Python, with declarations, suffixes and hosts that decide."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from evidara.llm import language_id

SYLLABLES = {"fil": "ang mga sa ay ng ka", "fin": "inen ssa kin taan yy oo", "ceb": "ug ang sa kay og usa", "ces": "ych ova nej pro sti kou", "de": "ung sch ein der keit ver"}


def texts_of(draw, lang, n, words):
    return [" ".join(draw.choice(SYLLABLES[lang].split()) + draw.choice(SYLLABLES[lang].split()) for _ in range(words)) for _ in range(n)]


def plain_grams(text):
    b = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in text.encode()]
    out = []
    for x, y, z in zip(b, b[1:], b[2:]):  # noqa: B905
        if not (x == 32 == y or y == 32 == z):
            h = ((x * 0x9E3779B1) & 0xFFFFFFFF) ^ ((y * 0x85EBCA6B) & 0xFFFFFFFF) ^ ((z * 0xC2B2AE35) & 0xFFFFFFFF)
            out.append((h * 0x27D4EB2F & 0xFFFFFFFF) >> 16)
    return out


def plain_label(x):
    m = re.match(r"([a-z]{2,3})(?![a-z])", (x or "").strip().lower())
    return m and language_id.SAME.get(m[1], m[1])


def soft(x):
    e = [math.exp(v - max(x)) for v in x]
    return [v / sum(e) for v in e]


def plain_identify(pages, labelled, temper=60.0, m=20.0):
    """(lang, probability) of every page (text, declared, suffix, host, domain)."""
    counts = {}
    for text, lang in labelled:
        if plain_label(lang) and text is not None:
            own = counts.setdefault(plain_label(lang), {})
            for g in plain_grams(text):
                own[g] = own.get(g, 0) + 1
    langs, size = sorted(k for k, v in counts.items() if v), 1 << 16
    every = {}
    for k in langs:
        for g, n in counts[k].items():
            every[g] = every.get(g, 0) + n
    total = max(1.0, sum(every.values()) + 0.01 * size)
    back = lambda g: 0.5 * (every.get(g, 0) + 0.01) / total * size
    norm = {k: sum(counts[k].values()) + 0.5 * size for k in langs}

    def code(x):
        return "" if not (x or "").strip() else plain_label(x) if plain_label(x) in langs else "?"

    rows = []
    for text, declared, suffix, host, domain in pages:
        grams = plain_grams(text or "")
        ll = [sum(math.log((counts[k].get(g, 0) + back(g)) / norm[k]) for g in grams) for k in langs] + [-len(grams) * math.log(size)]
        ll = [v * min(1.0, temper / max(1, len(grams))) for v in ll]
        rows.append((len(grams), ll, soft(ll) if grams else [0.0] * len(ll), code(declared), code(suffix), host or "", domain or ""))
    k = len(langs) + 1
    summed = lambda test: [sum(r[2][i] for r in rows if test(r)) for i in range(k)]
    out = []
    for n, ll, p, d, s, h, o in rows:
        less = lambda v: [max(a - b, 0.0) for a, b in zip(v, p, strict=True)]  # noqa: B023, E731
        whole = less(summed(lambda r: True))
        base = [(v + 0.5) / (len(rows) + 0.5 * k) for v in whole]
        of_domain = [(v + m * b) / (sum(r[6] == o for r in rows) + m) for v, b in zip(less(summed(lambda r: r[6] == o)), base, strict=True)]  # noqa: B023
        prior = [(v + m * b) / (sum(r[5:] == (h, o) for r in rows) + m) for v, b in zip(less(summed(lambda r: r[5:] == (h, o))), of_domain, strict=True)]  # noqa: B023
        told = lambda i, x: [(v + 0.5) / (t + 0.5 * (k + 1)) for v, t in zip(less(summed(lambda r: r[i] == x)), whole, strict=True)]  # noqa: B023, E731
        post = soft([a + math.log(b) + math.log(c) + math.log(e) for a, b, c, e in zip(ll, prior, told(3, d), told(4, s), strict=True)])
        out.append(([*langs, "und"][post.index(max(post))], max(post)) if n else ("und", 0.0))
    return out


def test_fusion_matches_plain_python(spark):
    draw = random.Random(8)
    labelled = [(t, lang) for lang in SYLLABLES for t in texts_of(draw, lang, 6, 12)] + [("x y", "klingon"), (None, "de"), ("12 34", "xx"), ("ung keit", "deu-AT")]
    pages = []
    for i in range(70):
        lang = draw.choice(list(SYLLABLES))
        text = texts_of(draw, lang, 1, draw.choice([1, 2, 30]))[0]
        if i % 4 == 0:  # text that says little, so that the other evidence decides
            text = draw.choice(["sa ang", "ang sa", "", "ka"])
        declared = {0: f' lang="{lang}"', 1: f" class=x lang='{lang.upper()}-XX'", 2: "", 3: " lang=zz"}[i % 4 if i % 3 else 0]
        url = f"https://{lang}.site{i % 3}.example.{'de' if lang == 'de' else 'org'}/{lang if i % 2 else 'page'}/x?q={i}"
        pages.append((i, url if i % 13 else None, f"<html{declared}><script>var {text}</script><p>{text}</p>"))
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    columns = language_id.page_columns(F.col("url"), F.col("html"))
    rows = {r.page_id: r for r in frame.select("page_id", *(c.alias(k) for k, c in columns.items())).collect()}
    got = {r.page_id: r for r in language_id.identify(frame, spark.createDataFrame(labelled, "text string, lang string"), "page_id", **columns).collect()}
    order = sorted(rows)
    want = plain_identify([(rows[i].text, rows[i].declared, rows[i].suffix, rows[i].host, rows[i].domain) for i in order], labelled)
    for i, (lang, p) in zip(order, want, strict=True):
        assert got[i].lang == lang and got[i].probability == pytest.approx(p, abs=1e-4), i
    assert {got[i].lang for i in order} >= {"fil", "fi", "ceb", "cs", "de"}
    assert any(got[i].lang != got[i].text_lang for i in order)  # other evidence turned the text's verdict


def test_page_columns(spark):
    url, html = "HTTPS://Www.Shop.Example.DE:80/fin/page?x=/ces/", '<!doctype html><HTML data-x=1 LANG = "fil-PH"><style>p {}</style><!-- sa --><p>mga &amp; ka</p>'
    row = spark.createDataFrame([(url, html), (None, None), ("no address", "<html lang=english>x")], "url string, html string").select(*(c.alias(k) for k, c in language_id.page_columns(F.col("url"), F.col("html")).items())).collect()
    assert (row[0].host, row[0].domain, row[0].suffix, row[0].declared, row[0].text.split()) == ("www.shop.example.de", "example.de", "fin", "fil", ["mga", "&amp;", "ka"])
    assert (row[1].host, row[1].suffix, row[1].declared, row[1].text) == ("", "", "", "")
    assert (row[2].host, row[2].declared) == ("", "")


def test_more_languages_than_the_bound(spark):
    draw = random.Random(3)
    labelled = spark.createDataFrame([(t, lang) for k, lang in enumerate(sorted(SYLLABLES)) for t in texts_of(draw, lang, 3 + k, 8)], "text string, lang string")
    assert language_id.learned(labelled, "text", "lang", 3)[0] == ["de", "fi", "fil"]
