from dataclasses import replace
from datetime import date, datetime

import pytest

from tidemark.plans.pipelines import official_types
from tidemark import FEEDS, RAW_SCHEMA, clean_to_analytic, high_precision, raw_schema, raw_to_clean
from tidemark import needed_schema, read_raw
from tidemark.plans.pipelines import clean_rows
from weather import DAY, HOUR, LIMA, LONDON, NOON, day, document, hour, minute, weather, write_json

CURRENT, DAILY, HOURLY, MINUTELY = (FEEDS[n] for n in ("current", "daily", "hourly", "minutely"))

DOCUMENTS = [
    document(NOON, LONDON, (800, 801),
             hourly=[hour(NOON), hour(NOON + HOUR, rain={"1h": 0.5}, weather=[])],
             daily=[day(NOON)],
             minutely=[minute(NOON, 1.75), minute(NOON + 60, -0.5)]),
    document(NOON + 1, LIMA, (), hourly=[], daily=None),
    document(NOON + 13 * HOUR, LIMA, (300,), minutely=[minute(NOON, 0.0)]),
    {**LONDON, "hourly": [hour(NOON)]},
]


@pytest.fixture
def raw(spark, tmp_path):
    return read_raw(spark, write_json(tmp_path / "raw", DOCUMENTS), RAW_SCHEMA)


def by(df, *names):
    return sorted((tuple(row) for row in df.select(*(f"`{n}`" for n in names)).collect()), key=str)


@pytest.mark.parametrize("spec", FEEDS.values(), ids=FEEDS)
def test_clean_layers_have_their_official_types(raw, spec):
    types = dict(raw_to_clean(spec, raw).dtypes)
    expected = {n: {"integer": "int"}.get(t, t) for n, t in official_types(spec, list(types)).items()}
    assert spec is not CURRENT or "current_weather[1]_id" in types
    expected |= {"current_weather_time": "timestamp", "current_weather_date": "date",
                 "current_weather_date_partition": "date"}
    assert types == expected


def test_current_has_one_row_per_observation(raw):
    clean = raw_to_clean(CURRENT, raw)
    assert by(clean, "lat", "current_dt", "current_weather[0]_id", "current_weather[0]_main") == (
        sorted([(51.5, NOON, 800, "main800"), (-12.0, NOON + 1, None, None),
                (-12.0, NOON + 13 * HOUR, 300, "main300")], key=str))
    assert by(clean, "current_weather_date") == [
        (date(2024, 1, 1),), (date(2024, 1, 1),), (date(2024, 1, 2),)]
    assert {r[0] for r in by(clean, "current_temp")} == {281.66}


def test_hourly_has_one_row_per_hour(raw):
    clean = raw_to_clean(HOURLY, raw)
    assert by(clean, "current_dt", "hourly_weather_forecast_dt",
              "hourly_weather_forecast_feels_like", "hourly_weather_forecast_rain_1h",
              "hourly_weather_forecast_weather[0]_description") == sorted(
        [(NOON, NOON, 279, None, "description 500"), (NOON, NOON + HOUR, 279, 0.5, None)], key=str)


def test_daily_keeps_all_fields_of_both_structs(raw):
    row = raw_to_clean(DAILY, raw).first().asDict()
    prefix = "daily_weather_forecast_"
    got = {k.removeprefix(prefix): v for k, v in row.items() if k.startswith(prefix)}
    assert {k: got[k] for k in got if k.startswith(("temp", "feels"))} == {
        "temp_day": 283.5, "temp_min": 279.5, "temp_morn": 280.5, "temp_eve": 282.25,
        "temp_night": 281.5, "feels_like_day": 1.5, "feels_like_night": 2.5,
        "feels_like_morn": 3.5, "feels_like_eve": 4.5}
    assert got["sunrise"] == NOON - 4 * HOUR


def test_minutely_cuts_fractions_off(raw):
    clean = raw_to_clean(MINUTELY, raw)
    assert by(clean, "time_precipitation_amt_dt", "time_precipitation_amt_precipitation") == [
        (NOON, 0), (NOON, 1), (NOON + 60, 0)]
    precise = raw_to_clean(high_precision(MINUTELY), raw)
    assert by(precise, "time_precipitation_amt_precipitation") == [(-0.5,), (0.0,), (1.75,)]


def test_high_precision_has_no_float_left():
    assert "float" not in high_precision(DAILY).clean_types.values()
    assert high_precision(HOURLY).clean_types["hourly_weather_forecast_feels_like"] == "double"


def test_outer_keeps_observations_without_elements(raw):
    assert clean_rows(HOURLY, raw.where("current.dt > 0"), outer=True).count() == 4


def test_variants_are_merged(spark, tmp_path):
    documents = [document(NOON, hourly=[
        hour(NOON, temp={"int": 280}, wind_gust={"double": 6.5}),
        hour(NOON + 1, temp={"double": 280.25}, wind_gust={"int": 7, "double": 7.5}),
        hour(NOON + 2, temp=None, wind_gust={}),
    ])]
    for d in documents:
        d["current"]["temp"], d["current"]["wind_gust"] = {"int": 281}, {"double": 281.66}
    raw = read_raw(spark, write_json(tmp_path / "raw", documents),
                   raw_schema(["temp", "wind_gust"]))
    assert by(raw_to_clean(HOURLY, raw), "hourly_weather_forecast_temp",
              "hourly_weather_forecast_wind_gust") == sorted(
        [(280.0, 6.5), (280.25, 7.5), (None, None)], key=str)
    assert by(raw_to_clean(CURRENT, raw), "current_temp", "current_wind_gust") == [(281.0, 281.66)]
    as_float = raw_to_clean(replace(CURRENT, variant_type="float"), raw)
    assert by(as_float, "current_wind_gust") == [(281.6600036621094,)]


def test_inferred_and_declared_schemas_agree_and_unknown_fields_pass(spark, tmp_path):
    documents = [document(NOON, hourly=[hour(NOON, snow={"1h": 0.75}, rain={"1h": 0.25})],
                          daily=[day(NOON)], minutely=[minute(NOON, 1.0)])]
    path = write_json(tmp_path / "raw", documents)
    inferred, declared = read_raw(spark, path, None), read_raw(spark, path, RAW_SCHEMA)
    for spec in FEEDS.values():
        rows, wanted = raw_to_clean(spec, inferred), raw_to_clean(spec, declared)
        assert by(rows, *wanted.columns) == by(wanted, *wanted.columns)
    assert by(raw_to_clean(HOURLY, inferred), "hourly_weather_forecast_snow_1h") == [(0.75,)]


def test_increment_is_measured_by_the_clean_history(raw):
    history = raw_to_clean(CURRENT, raw).where(f"current_dt <= {NOON + 1}")
    assert by(raw_to_clean(CURRENT, raw, history), "current_dt") == [(NOON + 13 * HOUR,)]
    everything = raw_to_clean(CURRENT, raw)
    assert raw_to_clean(CURRENT, raw, everything).count() == 0
    assert raw_to_clean(HOURLY, raw, everything).count() == 2


def test_a_place_that_reports_late_can_be_measured_by_its_own_history(spark, tmp_path):
    documents = [document(NOON, LONDON), document(NOON - HOUR, LIMA), document(NOON + 1, LONDON)]
    raw = read_raw(spark, write_json(tmp_path / "raw", documents), RAW_SCHEMA)
    history = raw_to_clean(CURRENT, raw).where(f"current_dt = {NOON}")
    assert by(raw_to_clean(CURRENT, raw, history), "current_dt") == [(NOON + 1,)]
    per_place = raw_to_clean(CURRENT, raw, history, keys=("lat", "lon"))
    assert by(per_place, "current_dt") == [(NOON - HOUR,), (NOON + 1,)]


def test_copies_can_be_dropped(spark, tmp_path):
    documents = [document(NOON, hourly=[hour(NOON), hour(NOON), hour(NOON + HOUR)])] * 3
    raw = read_raw(spark, write_json(tmp_path / "raw", documents), RAW_SCHEMA)
    assert raw_to_clean(HOURLY, raw).count() == 9
    assert raw_to_clean(HOURLY, raw, dedupe=True).count() == 2


def test_copies_are_merged_before_they_are_shuffled(raw, plan):
    text = plan(raw_to_clean(HOURLY, raw, dedupe=True), "simple")
    before_shuffle = text.split("Exchange hashpartitioning")[1]
    assert text.count("Exchange hashpartitioning") == 1
    assert "Aggregate" in before_shuffle


def test_malformed_values_become_null_not_errors(spark, tmp_path):
    bad = document(NOON, weather=[])
    bad["current"]["pressure"] = "high"
    bad["timezone_offset"] = 10**12
    raw = read_raw(spark, write_json(tmp_path / "raw", [bad]), None)
    row = raw_to_clean(CURRENT, raw).first()
    assert (row["current_pressure"], row["timezone_offset"]) == (None, None)


LEADING = ["lat", "lon", "timezone", "timezone_offset", "current_weather_time",
           "current_weather_date", "current_weather_date_partition"]


@pytest.mark.parametrize("spec", FEEDS.values(), ids=FEEDS)
def test_analytic_layers_are_ordered_and_rid_of_ids(raw, spec):
    columns = clean_to_analytic(spec, raw_to_clean(spec, raw)).columns
    assert columns[: len(spec.leading)] == list(spec.leading)
    assert columns[:7] == LEADING
    rest = columns[len(spec.leading):]
    assert rest == sorted(rest)
    assert not [c for c in columns if "[0]" in c or c == "current_dt"]


def test_analytic_columns_of_each_feed(raw):
    current = clean_to_analytic(CURRENT, raw_to_clean(CURRENT, raw)).columns
    assert current[7:9] == ["current_sunrise_time", "current_sunset_time"]
    assert {"current_weather_state", "current_weather_state_desc"} <= set(current)
    assert not {"current_sunrise", "current_sunset"} & set(current)
    daily = clean_to_analytic(DAILY, raw_to_clean(DAILY, raw))
    assert dict(daily.dtypes)["daily_weather_forecast_sunrise"] == "int"
    assert {"daily_weather_state", "daily_weather_state_desc"} <= set(daily.columns)
    hourly = clean_to_analytic(HOURLY, raw_to_clean(HOURLY, raw)).columns
    assert {"hourly_weather_state", "hourly_weather_state_desc"} <= set(hourly)
    minutely = clean_to_analytic(MINUTELY, raw_to_clean(MINUTELY, raw)).columns
    assert minutely == [*LEADING, "time_precipitation_amt_dt",
                        "time_precipitation_amt_precipitation"]


def test_sunrise_becomes_a_time(raw):
    analytic = clean_to_analytic(CURRENT, raw_to_clean(CURRENT, raw))
    times = analytic.selectExpr("CAST(current_sunrise_time AS TIMESTAMP_NTZ) AS t",
                                "current_weather_state AS w")
    assert (datetime(2024, 1, 1, 8), "main800") in by(times, "t", "w")


def test_analytic_increment_is_strict_and_can_look_back(raw):
    clean = raw_to_clean(CURRENT, raw)
    analytic = clean_to_analytic(CURRENT, clean)
    assert clean_to_analytic(CURRENT, clean, analytic).count() == 0
    early = analytic.where("current_weather_date < '2024-01-02'")
    assert clean_to_analytic(CURRENT, clean, early).count() == 1
    assert clean_to_analytic(CURRENT, clean, early, lookback=DAY).count() == 3


@pytest.mark.parametrize("spec", FEEDS.values(), ids=FEEDS)
def test_hops_neither_shuffle_nor_join(raw, plan, spec):
    text = plan(clean_to_analytic(spec, raw_to_clean(spec, raw)), "simple")
    assert "Exchange" not in text and "Join" not in text and "Python" not in text
    assert text.count("Scan json") == 1


def test_a_feed_reads_its_own_fields_only(raw, plan):
    text = plan(raw_to_clean(MINUTELY, raw))
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "minutely" in schema and "hourly" not in schema and "daily" not in schema


def test_a_feed_reads_its_own_nested_fields_of_columnar_documents(raw, plan, spark, tmp_path):
    raw.write.parquet(f"{tmp_path}/columnar")
    text = plan(raw_to_clean(MINUTELY, spark.read.parquet(f"{tmp_path}/columnar")))
    assert (
        "ReadSchema: struct<lat:double,lon:double,timezone:string,timezone_offset:int,"
        "current:struct<dt:int>,minutely:array<struct<dt:int,precipitation:double>>>"
    ) in text
    assert "PushedFilters: [IsNotNull(current.dt), GreaterThan(current.dt,0)]" in text


def test_needed_schema_declares_what_feeds_read():
    assert needed_schema([MINUTELY]).simpleString() == (
        "struct<lat:double,lon:double,timezone:string,timezone_offset:int,"
        "current:struct<dt:int>,minutely:array<struct<dt:int,precipitation:double>>>"
    )
    both = needed_schema([CURRENT, DAILY])
    assert both.names == ["lat", "lon", "timezone", "timezone_offset", "current", "daily"]
    assert both["current"] == RAW_SCHEMA["current"]
    assert needed_schema(FEEDS.values()) == RAW_SCHEMA


def test_weather_helper_is_what_documents_hold():
    assert weather(1)[0]["icon"] == "1d"
