import os
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import (
    add_time_columns,
    high_water_mark,
    newer_than,
    newer_than_per_key,
    read_mark,
    run_if_any,
    write_partitioned,
)
from tidemark.operators.incremental import TIME_ZERO

DAY = 86400


def seconds(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "dt INT")


def kept(df, name="dt"):
    return sorted(row[0] for row in df.select(name).collect())


def test_mark_is_the_maximum_or_the_default(spark):
    assert read_mark(high_water_mark(seconds(spark, 3, None, 9, 4), "dt")) == 9
    assert read_mark(high_water_mark(seconds(spark, None), "dt")) == 0
    assert read_mark(high_water_mark(seconds(spark).limit(0), "dt", -7)) == -7


def test_timestamp_mark_and_its_default(spark):
    df = spark.sql("SELECT CAST('2024-03-31 02:30:00.123456' AS TIMESTAMP) AS t")
    mark = read_mark(high_water_mark(df, "t", TIME_ZERO))
    assert mark == datetime(2024, 3, 31, 2, 30, 0, 123456, tzinfo=timezone.utc)
    assert read_mark(high_water_mark(df.where("false"), "t", TIME_ZERO)) == TIME_ZERO
    assert kept(newer_than(df, "t", mark), "t") == []


def test_timestamp_mark_does_not_depend_on_the_zone_of_the_driver(spark):
    df = spark.sql(
        "SELECT timestamp_seconds(s) AS t, s FROM VALUES (1711846800), (1711846801) AS v(s)"
    )
    before = os.environ.get("TZ")
    os.environ["TZ"] = "Europe/Berlin"
    time.tzset()
    try:
        mark = read_mark(high_water_mark(df.where("s = 1711846800"), "t", TIME_ZERO))
        assert kept(newer_than(df, "t", mark), "s") == [1711846801]
    finally:
        if before is None:
            del os.environ["TZ"]
        else:
            os.environ["TZ"] = before
        time.tzset()


def test_mark_of_timestamps_without_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05.000006' AS t")
    mark = read_mark(high_water_mark(df, "t", datetime(1970, 1, 1)))
    assert mark == datetime(2024, 1, 2, 3, 4, 5, 6)
    assert newer_than(df, "t", mark).count() == 0
    assert newer_than(df, "t", mark, lookback=1).count() == 1


def test_increment_is_strict_and_drops_nulls(spark):
    df = seconds(spark, 99, 100, 101, None)
    assert kept(newer_than(df, "dt", 100)) == [101]


def test_look_back_is_strict_too(spark):
    mark = 10 * DAY
    df = seconds(spark, mark - 3 * DAY, mark - 3 * DAY + 1, mark, None)
    assert kept(newer_than(df, "dt", mark, lookback=3 * DAY)) == [mark - 3 * DAY + 1, mark]


def test_mark_as_a_frame_runs_within_the_query(spark):
    df = seconds(spark, 1, 5, 9)
    mark = high_water_mark(seconds(spark, 4, 5), "dt")
    assert kept(newer_than(df, "dt", mark)) == [9]
    assert kept(newer_than(df, "dt", mark, lookback=3)) == [5, 9]
    empty = high_water_mark(seconds(spark).limit(0), "dt")
    assert kept(newer_than(df, "dt", empty)) == [1, 5, 9]


def test_nested_path(spark):
    df = spark.sql("SELECT named_struct('dt', id) AS current, id FROM range(5)")
    assert kept(newer_than(df, "current.dt", 2), "id") == [3, 4]


def test_filter_on_a_nested_field_reaches_parquet_and_reads_that_field_only(
    spark, plan, tmp_path
):
    df = spark.sql("SELECT named_struct('dt', id, 'x', id) AS current, id AS other FROM range(5)")
    df.write.parquet(f"{tmp_path}/raw")
    text = plan(newer_than(spark.read.parquet(f"{tmp_path}/raw"), "current.dt", 2)
                .select("current.dt"))
    assert "GreaterThan(current.dt,2)" in text
    assert "ReadSchema: struct<current:struct<dt:bigint>>" in text


def layer(spark, path):
    df = spark.sql(f"SELECT CAST(id * {DAY // 4} + 100 AS INT) AS dt, 'x' AS other FROM range(80)")
    write_partitioned(add_time_columns(df, "dt", "seen"), path, "seen_date_partition")
    return spark.read.parquet(path)


def test_mark_by_partition_reads_the_newest_directories(spark, plan, tmp_path):
    rows = layer(spark, f"{tmp_path}/layer")
    mark = high_water_mark(rows, "dt", 0, partition="seen_date_partition")
    assert read_mark(mark) == read_mark(high_water_mark(rows, "dt"))
    text = plan(mark)
    assert "PartitionFilters: [isnotnull(seen_date_partition" in text
    assert "ReadSchema: struct<>" in text
    timed = high_water_mark(rows, "seen_time", TIME_ZERO, partition="seen_date_partition")
    assert read_mark(timed) == read_mark(high_water_mark(rows, "seen_time", TIME_ZERO))
    empty = rows.where("dt < 0")
    assert read_mark(high_water_mark(empty, "dt", 0, partition="seen_date_partition")) == 0


def test_increment_by_partition_prunes_directories(spark, plan, tmp_path):
    rows = layer(spark, f"{tmp_path}/layer")
    mark = datetime(1970, 1, 15, 6, 1, 40, tzinfo=timezone.utc)
    newer = newer_than(rows, "seen_time", mark, partition="seen_date_partition")
    assert newer.count() == newer_than(rows, "seen_time", mark).count() == 22
    assert "seen_date_partition" in plan(newer).split("PartitionFilters:")[1].split("\n")[0]
    files = newer.select("seen_date_partition").distinct().count()
    assert files == 6


def test_increment_per_key_measures_each_by_its_own_history(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES ('a', 5), ('a', 11), ('late', 3), ('late', 2), ('new', 1),
                                (NULL, 4), (NULL, 9), ('a', NULL) AS t(place, dt)"""
    )
    history = spark.sql("SELECT * FROM VALUES ('a', 10), ('late', 2), (NULL, 5) AS t(place, dt)")
    newer = newer_than_per_key(rows, "dt", history, ["place"])
    assert newer.columns == ["place", "dt"]
    assert sorted(map(tuple, newer.collect()), key=str) == sorted(
        [("a", 11), ("late", 3), ("new", 1), (None, 9)], key=str
    )
    back = newer_than_per_key(rows, "dt", history, ["place"], lookback=6)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(
        [("a", 5), ("a", 11), ("late", 3), ("late", 2), ("new", 1), (None, 4), (None, 9)], key=str
    )
    everything = newer_than(rows, "dt", read_mark(high_water_mark(history, "dt")))
    assert everything.count() == 1


def test_increment_per_key_with_history_from_the_same_frame(spark):
    rows = spark.sql("SELECT id % 3 AS place, id AS dt FROM range(30)")
    newer = newer_than_per_key(rows, "dt", rows.where("dt < 15"), ["place"])
    assert sorted(row.dt for row in newer.collect()) == list(range(15, 30))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_per_key_marks_are_broadcast_by_measured_size_else_joined_by_shuffle(
    spark, plan, threshold
):
    rows = spark.sql("SELECT IF(id % 3 = 0, 0, id % 50) AS place, id AS dt FROM range(3000)")
    history = rows.where("dt < 1500")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        newer = newer_than_per_key(rows, "dt", history, ["place"])
        text = plan(newer, "simple")
        assert ("BroadcastHashJoin" in text) == (threshold != "-1")
        assert ("SortMergeJoin" in text) == (threshold == "-1")
        expected = rows.join(
            history.groupBy("place").agg(F.max("dt").alias("m")), "place", "left"
        ).where("dt > coalesce(m, 0)")
        assert newer.count() == expected.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_beyond_the_broadcast_threshold_is_split(spark, plan):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.sql(
            "SELECT IF(id % 3 = 0, 0, id % 500) AS place, id AS dt, "
            "sha2(CAST(id AS STRING), 256) AS text FROM range(0, 20000, 1, 16)"
        )
        newer = newer_than_per_key(rows, "dt", rows.where("dt < 3000"), ["place"])
        assert len(newer.collect()) == 17000
        text = plan(newer, "simple")
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "SortMergeJoin(skew=true)" in text


def test_gate(spark):
    calls = []
    assert run_if_any(seconds(spark).limit(0), calls.append) is None
    assert calls == []
    assert run_if_any(seconds(spark, 1), lambda df: df.count()) == 1


def test_running_again_with_the_mark_advanced_gives_nothing(spark):
    df = seconds(spark, 1, 5, 9)
    first = newer_than(df, "dt", 0)
    assert newer_than(df, "dt", high_water_mark(first, "dt")).count() == 0


def test_staged_gate_computes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(10, numPartitions=2).mapInArrow(count, "id long")
    assert run_if_any(rows, lambda df: (df.count(), df.agg(F.max("id")).first()[0]), stage=True) == (10, 9)
    assert seen.value == 10
    assert run_if_any(rows.where("id > 50"), lambda df: df.count(), stage=True) is None
