"""The pipeline as a whole, and registered queries with SQL."""

import os

import pytest

import corpus_pipeline
from checks.compare import connect, differences
from tidewell.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_stages_pass_rows_on(spark, odd, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "ngram_join", "pii", "packing"]
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
    text = words + " mail me at joe@mail.example.com."
    more = odd.sparkSession.createDataFrame(
        [(100, text), (101, text.upper()), (102, text + " again"), (103, "few words")], "doc_id bigint, text string")
    docs = odd.unionByName(more, allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, FOLDER)
        assert docs.columns == before.columns, name
        docs.write.parquet(path := str(tmp_path / name))
        docs = spark.read.parquet(path)
    rows = {r.doc_id: r.text for r in docs.collect()}
    # 100 and 101 are equal but for case, the greater id stays; 102 is a near copy of it.
    assert rows == {101: words.upper() + " MAIL ME AT [EMAIL]."}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert [(r.doc_id, r.offset) for r in packed] == [(101, 0)]


def test_stages_on_an_empty_table(spark, nothing, tmp_path):
    docs = nothing
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        docs.write.parquet(path := str(tmp_path / name))
        docs = spark.read.schema(docs.schema).parquet(path)
        assert docs.count() == 0, name


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(rows[0].asDict())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert differences(got, connect(FOLDER).execute(queries.ORACLES[name]).df()) == []
