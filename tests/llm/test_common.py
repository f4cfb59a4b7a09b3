"""Helpers shared by the operators."""

from tidewell.llm import common


def test_least_hashes_are_those_of_a_full_sort(spark):
    from pyspark.sql import functions as F
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    want = [r.doc_id for r in df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(300).collect()]
    assert [r.doc_id for r in common.least_hashes(df, ["doc_id"], 300, 20_000).collect()] == want
    assert common.least_hashes(df.where("doc_id < 5"), ["doc_id"], 300, 5).count() == 5


def test_fresh_names(spark):
    df = spark.range(1).selectExpr("id as Kept", "1 as kept_")
    assert common.fresh(df, "kept", "other") == ["kept__", "other"]
