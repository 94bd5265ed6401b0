import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark import compact, parse_raw, raw_schema, read_layer, read_raw, read_table
from tidemark import write_partitioned
from tidemark.plans.feeds import RAW_SCHEMA
from tidemark.sources.staging import staged, staging_path, staging_root
from tidemark.sources.writers import require_apart


def directories(path):
    return sorted(os.path.basename(d) for d in glob.glob(f"{path}/day=*"))


def sample(spark, *days):
    values = ", ".join(f"({i}, DATE '{day}')" for i, day in enumerate(days))
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(id, day)")


def test_raw_reads_declared_fields_and_survives_malformed_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"lat": 1.5, "current": {"dt": 7, "unknown": 1}, "more": 2}\n'
        "not json\n"
        '{"lat": 2, "hourly": [{"dt": 8, "rain": {"1h": 0.5}}]}\n'
    )
    raw = read_raw(spark, str(tmp_path), RAW_SCHEMA)
    assert raw.schema == RAW_SCHEMA
    rows = raw.select("lat", "current.dt", F.col("hourly")[0]["rain"]["1h"]).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(1.5, 7, None), (None, None, None), (2.0, None, 0.5)], key=str
    )


def test_raw_can_be_inferred(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"lat": 1.5, "current": {"dt": 7, "unknown": 1}}\n')
    raw = read_raw(spark, str(tmp_path), None)
    assert raw.select("current.unknown").first()[0] == 1


def test_only_needed_columns_of_json_are_parsed(spark, plan, tmp_path):
    (tmp_path / "a.json").write_text('{"lat": 1.5, "current": {"dt": 7}}\n')
    text = plan(read_raw(spark, str(tmp_path), RAW_SCHEMA).select("lat", "timezone"))
    assert "ReadSchema: struct<lat:double,timezone:string>" in text


def test_text_column_is_parsed(spark):
    df = spark.createDataFrame([('{"lat": 3, "daily": [{"temp": {"day": 1.5}}]}',)], "body STRING")
    parsed = parse_raw(df, F.col("body"), raw_schema())
    assert parsed.selectExpr("lat", "daily[0].temp.day").first() == (3.0, 1.5)


def test_text_is_parsed_once_though_fields_are_filtered(spark, plan):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    parsed = parse_raw(df, F.col("props"), "k INT, m INT").where("k > 5").select("k")
    text = plan(parsed, "extended")
    assert text[text.index("== Physical Plan =="):].count("from_json") == 1
    nulls = parse_raw(spark.sql("SELECT CAST(NULL AS STRING) AS t"), F.col("t"), "k INT")
    assert nulls.first() == (None,)


def test_overwrite_all_replaces_everything(spark, tmp_path):
    path = f"{tmp_path}/layer"
    write_partitioned(sample(spark, "2024-01-01", "2024-01-02"), path, "day")
    write_partitioned(sample(spark, "2024-01-03"), path, "day")
    assert directories(path) == ["day=2024-01-03"]


def test_overwrite_touched_replaces_only_those_dates(spark, tmp_path):
    path = f"{tmp_path}/layer"
    write_partitioned(sample(spark, "2024-01-01", "2024-01-02"), path, "day")
    rows = spark.sql("SELECT 9 AS id, DATE '2024-01-02' AS day")
    write_partitioned(rows, path, "day", overwrite="touched")
    back = read_layer(spark, path)
    assert dict(back.dtypes) == {"id": "int", "day": "date"}
    assert sorted((r.id, str(r.day)) for r in back.collect()) == [
        (0, "2024-01-01"), (9, "2024-01-02")
    ]


def test_the_session_setting_does_not_change_the_mode(spark, tmp_path):
    path = f"{tmp_path}/layer"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_partitioned(sample(spark, "2024-01-01"), path, "day")
        write_partitioned(sample(spark, "2024-01-02"), path, "day")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert directories(path) == ["day=2024-01-02"]


def test_a_layer_is_rewritten_by_way_of_staging(spark, tmp_path):
    path = f"{tmp_path}/layer"
    write_partitioned(sample(spark, "2024-01-01", "2024-01-02"), path, "day")
    with staged(read_layer(spark, path).where("id = 0"), "rewrite") as rows:
        write_partitioned(rows, path, "day")
    assert [r.id for r in read_layer(spark, path).collect()] == [0]


def test_paths_that_lie_within_each_other_are_refused():
    require_apart("/data/clean", "/data/analytic")
    require_apart("/data/clean", "/data/clean2")
    for source, target in [("/data/x", "/data/x/"), ("/data/x", "/data/x/y"), ("/a/b", "/a")]:
        with pytest.raises(ValueError):
            require_apart(source, target)


def test_compacting_gives_one_file_per_small_date(spark, tmp_path):
    rows = spark.sql("SELECT id, date_add(DATE '2024-01-01', CAST(id % 5 AS INT)) AS day "
                     "FROM range(0, 1000, 1, 8)")
    write_partitioned(rows, f"{tmp_path}/spread", "day")
    write_partitioned(compact(rows, "day"), f"{tmp_path}/compact", "day")
    write_partitioned(compact(rows, "day", n=3), f"{tmp_path}/compact3", "day")
    assert len(glob.glob(f"{tmp_path}/spread/day=*/*.parquet")) == 40
    assert len(glob.glob(f"{tmp_path}/compact/day=*/*.parquet")) == 5
    assert len(glob.glob(f"{tmp_path}/compact3/day=*/*.parquet")) == 5
    assert read_layer(spark, f"{tmp_path}/compact").count() == 1000


def test_compacting_splits_a_date_that_holds_most_rows(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.sql(
            "SELECT id, sha2(CAST(id AS STRING), 256) AS text, "
            "IF(id % 3 = 0, DATE '2024-01-01', date_add(DATE '2024-01-01', CAST(id % 9 AS INT))) "
            "AS day FROM range(0, 20000, 1, 16)"
        )
        write_partitioned(compact(rows, "day"), f"{tmp_path}/hot", "day")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{tmp_path}/hot/day=2024-01-01/*.parquet")) > 1
    assert read_layer(spark, f"{tmp_path}/hot").count() == 20000


def test_files_can_be_bounded(spark, tmp_path):
    rows = spark.sql("SELECT id, DATE '2024-01-01' AS day FROM range(0, 100, 1, 1)")
    write_partitioned(rows, f"{tmp_path}/layer", ["day"], max_records_per_file=30)
    assert len(glob.glob(f"{tmp_path}/layer/day=*/*.parquet")) == 4


def test_catalog_tables_by_qualified_name(spark, tmp_path):
    spark.sql(f"CREATE DATABASE tide_clean LOCATION '{tmp_path}/clean.db'")
    spark.sql("CREATE TABLE tide_clean.hourly USING parquet AS SELECT 41 AS current_dt")
    try:
        assert read_table(spark, "hourly", "tide_clean").first()[0] == 41
        assert spark.catalog.currentDatabase() == "default"
    finally:
        spark.sql("DROP DATABASE tide_clean CASCADE")
    spark.range(3).createOrReplaceTempView("tide_view")
    assert read_table(spark, "tide_view").count() == 3


def test_staged_rows_are_files_in_the_shared_folder_for_as_long_as_needed(spark):
    root = staging_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert staging_path(spark, "x") != staging_path(spark, "x")
    with staged(spark.range(10), "numbers") as df:
        (file, *_) = df.inputFiles()
        assert root in file
        assert df.where("id > 6").count() == 3
    assert not glob.glob(f"{root}/tidemark/numbers-*")


def test_staging_is_cleared_when_the_work_fails(spark):
    with pytest.raises(RuntimeError):
        with staged(spark.range(10), "failing"):
            raise RuntimeError
    assert not glob.glob(f"{staging_root(spark)}/tidemark/failing-*")


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_root(Session())
