from pyspark.sql import functions as F

import corpus_pipeline
from tallybrook.llm.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_only_drop_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).unionAll(docs.filter("doc_id = 5")).unionAll(docs.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(-1).cast("long")))
    docs = docs.unionAll(extra).withColumn("score", F.lit("clash")).withColumn("component_id", F.lit(1))
    before = docs.count()
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        path = str(tmp_path / str(number))
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if name != "tokens":
            assert out.columns == docs.columns and out.exceptAll(docs).isEmpty(), name
        assert 0 < out.count() <= before, name
        before, docs = out.count(), out
    assert docs.filter("doc_id = 5").count() <= 1 and docs.filter("doc_id = -1").isEmpty()


def test_queries_have_stable_columns(spark):
    for name in ORACLES:
        assert QUERIES[name](spark, SF).columns, name
