"""The pipeline's runs and what they leave."""

import glob
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import queries, registry  # noqa: F401
from tidemark.sources.staging import staging_root

SF_DIR = "/root/testdata/sf0.001"


def left(spark):
    return set(glob.glob(f"{staging_root(spark)}/tidemark/{spark.sparkContext.applicationId}/*"))


def rows(df):
    return Counter(tuple(r) for r in df.drop("sequence_id", "offset").collect())


def test_interleaved_runs_do_not_touch_each_other(spark):
    before = left(spark)
    one = corpus_pipeline.run(spark, SF_DIR)
    assert len(left(spark) - before) == 1  # the rows of the result
    other = corpus_pipeline.run(spark, SF_DIR)
    assert rows(one) == rows(other) and one.count() > 0
    assert len(left(spark) - before) == 2


def test_failed_stage_leaves_nothing(spark, monkeypatch):
    def broken(spark, docs, sf_dir):
        return docs.withColumn("text", F.raise_error("lost").cast("string"))

    broken.__wrapped__ = broken
    stages = [*corpus_pipeline.STAGES[:2], ("broken", broken)]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    before = left(spark)
    with pytest.raises(Exception, match="lost"):
        corpus_pipeline.run(spark, SF_DIR)
    assert not left(spark) - before


def test_stages_on_odd_rows(spark, tmp_path):
    """NULL ids and texts, empty texts, repeated rows and an empty table, stage by stage."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    passage = " ".join(f"w{i}" for i in range(60))
    odd = [(1, passage, "en", "a", 1), (1, passage, "en", "a", 1), (2, None, "en", None, None), (3, "", "en", "a", 0), (None, passage + " x", "en", "a", 1),
           (None, None, None, None, None), (4, "x" * 300_000, "en", "a", 1), (5, f"other {passage} end", "en", "a", 1)]
    for name, table in (("some", odd), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(table, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(i, 1, 0) for i in range(1, 6)][: len(table)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for step, function in corpus_pipeline.STAGES[:-1]:
            out = function(spark, docs, folder)
            assert out.columns == docs.columns
            out.write.parquet(f"{folder}/{step}")
            docs = spark.read.parquet(f"{folder}/{step}")
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0) == (name == "none")
        assert (corpus_pipeline.run(spark, folder).count() == 0) == (name == "none")


@pytest.mark.parametrize("name", ["op4_exact_dedup", "op6_nearest_neighbours", "op9_minhash_neardup"])
def test_queries_leave_their_result_only(spark, name):
    before = left(spark)
    found = registry.QUERIES[name](spark, SF_DIR)
    assert len(left(spark) - before) == 1 and found.count() > 0
