"""The pipeline's stages: what each keeps and what it must not keep."""

import random

import corpus_pipeline
from evidara.llm import queries

COLUMNS = ["doc_id", "lang", "n_chars", "source", "text"]


def test_stages_keep_columns_and_drop_copies(spark):
    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).toPandas(), docs.schema)
        assert sorted(docs.columns) == COLUMNS, name
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    assert docs.select("doc_id").distinct().count() == docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.where("piece = 0").count() == docs.count()


def test_odd_rows_pass_every_stage(spark):
    sf = "/root/testdata/sf0.001"
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "a", 0, "x"), (3, "the and of with that " * 50, None, None, None, None), (3, "the and of with that " * 50, None, None, None, None)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf).collect()


def test_passages_of_more_than_50_words_go(spark):
    draw = random.Random(7)
    some = lambda n: [draw.choice("abcdefgh") + str(draw.randrange(10**4)) for _ in range(n)]
    rows, want = [], {}

    def add(left, passage, right, goes):
        i = len(rows)
        rows.append((i, " ".join([*left, *passage, *right]), "en", "s", 0))
        want[i] = " ".join(left) + "  " + " ".join(right) if goes else rows[i][1]

    for n in range(45, 63):
        passage = some(n)
        for _ in range(2):
            add(some(30), passage, some(20), n > 50)
    short = some(51)
    short = [x[0] for x in short]
    add(some(30), short, some(30), True)
    add(some(30), short, some(30), True)
    # two repeats of 30 words each side by side aren't one of 60
    a, b = some(30), some(30)
    add(some(5), a + b, some(5), False)
    add(some(5), a, some(5), False)
    add(some(5), b, some(5), False)
    # other gaps between the words; a document of the passage alone; copies of fewer than 400 bytes
    lines = [x[:2] for x in some(60)]
    add(some(5), lines, some(5), True)
    copied = "\n".join(x[:1] for x in some(55))
    rows += [(100, "\n".join(lines) + "\n", "en", "s", 0), (101, copied, "en", "s", 0), (102, copied, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.passages(spark, docs, "").collect()}
    assert got == want


def test_run_writes_every_stage_and_packs_all_that_is_kept(spark):
    sf = "/root/testdata/sf0.001"
    packed = corpus_pipeline.run(spark, sf)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    n = queries.table(spark, sf, "documents").count()
    kept = packed.where("piece = 0").select("doc_id").distinct().count()
    assert 0.5 * n < kept < n


def test_one_row_of_an_id_stays(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    rows = [(1, "b b b", "en", "s", 5, "x"), (1, "a a a", "en", "s", 5, "y"), (1, None, "en", "s", 0, "z"), (2, "c", None, None, None, None)]
    got = sorted((r.doc_id, r.text or "") for r in corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, schema), "").collect())
    assert got == [(1, ""), (2, "c")]
