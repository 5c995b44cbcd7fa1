"""The pipeline: every stage alone, and all of them."""

import edge

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_drop_rows_only(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SMALL)
        assert found.columns == docs.columns, name
        ids = [r["doc_id"] for r in found.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) <= docs.count()


def test_stages_stand_odd_rows(spark):
    docs = edge.frame(spark)
    for name, stage in corpus_pipeline.STAGES:
        if name != "pii":
            assert stage(spark, docs, SMALL).count() > 0, name
            stage(spark, edge.nothing(spark), SMALL).count()


def test_run(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.columns == "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()
    assert found.count() > 100
    whole = found.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"})
    assert whole.where("`sum(length)` <> `max(doc_tokens)`").count() == 0
