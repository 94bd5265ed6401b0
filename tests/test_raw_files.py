import glob

import pytest
from pyspark.sql import functions as F

from tidemark import FEEDS, read_raw
from tidemark.workload.feed_queries import _json_files
from tidemark.workload.inputs import RAW_FILES, events, spread

CURRENT = FEEDS["current"]


@pytest.fixture
def some_events(spark, tmp_path):
    """25,000 events in one row group."""
    spark.range(25_000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) AS ts",
        "id % 50 AS user_id", "'view' AS event_type", "id * 0.5D AS value", "'' AS props",
    ).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    return events(spark, str(tmp_path))


def test_raw_files_are_compressed_and_bounded(spark, some_events):
    path = _json_files(spark, CURRENT, some_events)
    files = glob.glob(f"{path}/part-*")
    assert files and all(file.endswith(".json.lz4") for file in files)
    rows = spark.read.text(path).groupBy(F.input_file_name()).count().collect()
    assert sum(row["count"] for row in rows) == 25_000
    assert max(row["count"] for row in rows) <= int(RAW_FILES["maxRecordsPerFile"])
    assert read_raw(spark, path, None).select("current.dt").distinct().count() == 25_000


def test_events_are_dealt_over_tasks(spark, some_events, plan):
    assert "rangepartitioning(event_id" in plan(spread(some_events), "simple")
    with_copies = some_events.unionAll(some_events).withColumn("event_id", F.when(F.col("event_id") > 5, F.col("event_id")))
    assert spread(with_copies).exceptAll(with_copies).isEmpty() and spread(with_copies).count() == 50_000
