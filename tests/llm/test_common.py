"""Written tables, their removal, and the shared folder."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridtide.llm import common


def test_written_and_forgotten(spark):
    df = common.written(spark.range(10).withColumn("k", F.col("id") % 3).groupBy("k").count(), "t")
    assert df.count() == 3
    common.forget(df, None, spark.range(3))
    with pytest.raises(Exception, match="exist|NOT_FOUND|FILE"):
        df.collect()


def test_long_texts_are_read_in_small_batches_while_tables_are_written(spark):
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(k) for k in keys]
    with common.writing(spark):
        assert all(int(spark.conf.get(k)) <= 500 for k in keys)
    assert [spark.conf.get(k) for k in keys] == before


def test_texts_are_not_read_a_whole_row_group_at_once(spark):
    vectored = lambda: spark._jsparkSession.sessionState().newHadoopConf().get("parquet.hadoop.vectored.io.enabled")
    before = vectored()
    with common.writing(spark):
        assert vectored() == "false"
    assert vectored() == before


def test_a_stage_of_the_pipeline_has_its_texts_read_in_pieces(spark):
    before = {k: spark.conf.get(k, None) for k in common.IN_PIECES}
    for k in common.IN_PIECES:
        spark.conf.unset(k)
    try:
        seen = corpus_pipeline.in_pieces(lambda s, docs, sf_dir: (docs, sf_dir, [s.conf.get(k, None) for k in common.IN_PIECES]))
        assert seen(spark, "docs", "dir") == ("docs", "dir", list(common.IN_PIECES.values()))
        # the caller writes what a stage returns after it, so the setting stays
        assert [spark.conf.get(k, None) for k in common.IN_PIECES] == list(common.IN_PIECES.values())
        assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_words_and_folds(spark):
    row = spark.createDataFrame([(" a\tb\x0bc d ", None)], "t string, n string").select(common.words(F.col("t")), common.words(F.col("n"))).first()
    assert row[0] == ["a", "b", "c d"] and row[1] == []
    ids = spark.range(50).select("id", common.is_held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == common.held_out(r.id) for r in ids)


def test_bind_computes_once(spark):
    out = spark.range(1).select(common.bind(F.rand(), lambda x: x - x)).first()[0]
    assert out == 0.0


def test_rows_without_an_id_are_never_dropped(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "doc_id long, text string")
    ids = spark.createDataFrame([(2,), (2,), (None,), (9,)], "some long")
    for most in (common.BROADCAST_IDS, 0):
        monkeypatch.setattr(common, "BROADCAST_IDS", most)
        assert sorted(r.text for r in common.without(docs, ids).collect()) == ["a", "c"]
