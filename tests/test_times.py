from datetime import date, datetime

from tidemark import add_time_columns, epochs_to_times


def test_days_are_cut_at_utc_midnight_not_by_the_offset_of_the_place(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1704067199, -18000), (1704067200, 32400), (NULL, 0) AS t(dt, off)"
    )
    rows = add_time_columns(df, "dt", "seen").selectExpr(
        "CAST(seen_time AS TIMESTAMP_NTZ) AS t", "seen_date", "seen_date_partition"
    ).collect()
    assert [tuple(row) for row in rows] == [
        (datetime(2023, 12, 31, 23, 59, 59), date(2023, 12, 31), date(2023, 12, 31)),
        (datetime(2024, 1, 1), date(2024, 1, 1), date(2024, 1, 1)),
        (None, None, None),
    ]


def test_session_time_zone_decides(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT 1704067200 AS dt")
        assert add_time_columns(df, "dt", "seen").first()["seen_date"] == date(2023, 12, 31)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_second_far_out_of_range_does_not_fail_the_job(spark):
    df = spark.sql("SELECT 9223372036854775807L AS dt")
    assert add_time_columns(df, "dt", "seen").where("seen_date IS NOT NULL").count() == 1


def test_epochs_are_replaced(spark):
    df = spark.sql("SELECT 5 AS sunrise, 'x' AS other, CAST(NULL AS INT) AS sunset")
    times = epochs_to_times(df, {"sunrise": "sunrise_time", "sunset": "sunset_time"})
    assert dict(times.dtypes) == {
        "other": "string", "sunrise_time": "timestamp", "sunset_time": "timestamp"
    }
    row = times.selectExpr("unix_seconds(sunrise_time) AS a", "sunset_time AS b").first()
    assert tuple(row) == (5, None)
