"""What operators leave on disk and what they move: shuffle files, tables on the way, texts that no range or pair needs."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from evidara import session
from evidara.llm import repeats


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_a_cut_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    made = session.cut(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    assert made.count() == 7
    spark.range(10).repartition(2).write.format("noop").mode("overwrite").save()  # a shuffle of its own, which stays
    left = shuffle_files(spark) - before
    assert len({name.split("_")[1] for name in left}) <= 2, left  # of the count and of the last write
    assert spark.conf.get(session.FREED) == "false"


def test_settled_deletes_what_was_cut_on_the_way(spark):
    before = set(session._made)

    def make():
        first = session.cut(spark.range(10))
        return session.settled(lambda: session.cut(first.where("id > 3"))).where("id < 8")

    made = session.settled(make)
    assert set(session._made) - before == {made.cut_path}
    assert sorted(r.id for r in made.collect()) == [4, 5, 6, 7]


def test_near_copies_keeps_no_table_of_the_search(spark):
    rows = [(i, f"{'some words that many texts have in common ' * 9}{i // 2}", "en", "s", 0) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    before = set(session._made)
    assert corpus_pipeline.near_copies(spark, docs, "").count() < 20
    assert len(set(session._made) - before) == 2  # the links, and ids of several rows


def test_marked_misses_no_key_and_few_others(spark, monkeypatch):
    for most in (1 << 26, 1 << 10):  # with few bits more rows are true, none is missed
        monkeypatch.setattr(session, "MOST_BITS", most)
        ids = spark.range(0, 40000).select(F.col("id"), F.unhex(F.md5(F.col("id").cast("string"))).alias("key"))
        keys = ids.where("id % 8 = 0").select("key")
        told = session.marked(ids, keys, "key", "hit")
        assert told.columns == ["id", "key", "hit"]
        got = {r.id: r.hit for r in told.select("id", "hit").collect()}
        assert len(got) == 40000 and all(got[i] for i in range(0, 40000, 8))
        if most > 1 << 10:
            assert sum(got[i] for i in range(40000) if i % 8) < 35000 / 10
    assert session.likely(ids, keys.where("false"), "key").count() == 0


def test_texts_without_ranges_pass_unmoved(spark):
    draw = random.Random(3)
    fresh = lambda n: "".join(draw.choice("abcdefghijklm ") for _ in range(n))
    twice, copy = fresh(450), fresh(500)
    texts = [fresh(600), None, "", fresh(30) + twice, twice + fresh(20), copy, copy, "é" * 10]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("x"))
    rows = repeats.remove_repeats(docs, with_text=True, keep=["lang"])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_text, r.lang) for r in rows.collect()}
    want = {i: (len((t or "").encode()), 0, 0, t or "", "x") for i, t in enumerate(texts)}
    want |= {3: (480, 450, 1, texts[3][:30], "x"), 4: (470, 450, 1, texts[4][450:], "x"), 5: (500, 500, 1, "", "x"), 6: (500, 500, 1, "", "x")}
    assert got == want
