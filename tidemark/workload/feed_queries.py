"""The pipelines of the four feeds over documents derived from ``events``."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.feeds import (
    CURRENT,
    CURRENT_DT,
    DAILY,
    FEEDS,
    HOURLY,
    MINUTELY,
    WEATHER_TIME,
    FeedSpec,
    high_precision,
    needed_schema,
)
from tidemark.plans.jobs import layer_path, run_clean_to_analytic, run_raw_to_clean
from tidemark.plans.pipelines import clean_to_analytic, raw_to_clean
from tidemark.sources.layers import read_layer
from tidemark.sources.readers import parse_raw, read_raw
from tidemark.sources.staging import staging_path
from tidemark.streaming import clean_stream, read_raw_stream, start_layer
from tidemark.workload.inputs import (
    CUTOFF,
    DOCUMENT_SCHEMA,
    RAW_FILES,
    clean_sql,
    documents,
    documents_of,
    events,
    spread,
)
from tidemark.workload.registry import Registry, without_zone

registry = Registry()


def _processed(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))


def _clean_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a clean layer would hold had it been filled up to the cut-off."""
    return _processed(events(spark, sf_dir)).select(F.col("s").alias(CURRENT_DT))


def _analytic_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an analytic layer would hold had it been filled up to the cut-off."""
    return _clean_history(spark, sf_dir).select(
        F.col(CURRENT_DT).cast("timestamp").alias(WEATHER_TIME)
    )


def _newest_sql() -> str:
    return (
        "(SELECT CAST(max(floor(epoch(ts))) AS INTEGER) FROM events "
        f"WHERE ts < TIMESTAMP '{CUTOFF}')"
    )


def _analytic_sql(spec: FeedSpec, where: str = "true") -> str:
    """The clean layer's SQL with the analytic layer's columns."""
    dropped = [name for name in (*spec.drops, *spec.epochs_to_times)
               if name in spec.clean_types]
    excluded = ", ".join(f'"{name}"' for name in (*dropped, *spec.renames))
    added = [f'"{old}" AS "{new}"' for old, new in spec.renames.items()] + [
        f"CAST(to_timestamp({old}) AT TIME ZONE 'UTC' AS TIMESTAMP) AS {new}"
        for old, new in spec.epochs_to_times.items()
    ]
    columns = ", ".join([f"* EXCLUDE ({excluded})", *added])
    return f"SELECT {columns} FROM ({clean_sql(spec.name, where)})"


def _register(spec: FeedSpec) -> None:
    newer = f"s > {_newest_sql()}"
    newer_with_lookback = f"s > {_newest_sql()} - {spec.lookback}"

    @registry.add(f"clean_{spec.name}", clean_sql(spec.name))
    def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
        return without_zone(raw_to_clean(spec, documents(spark, sf_dir)))

    @registry.add(f"clean_{spec.name}_increment", clean_sql(spec.name, newer_with_lookback))
    def clean_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
        history = _clean_history(spark, sf_dir)
        return without_zone(raw_to_clean(spec, documents(spark, sf_dir), history))

    @registry.add(f"analytic_{spec.name}", _analytic_sql(spec))
    def analytic(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = raw_to_clean(spec, documents(spark, sf_dir))
        return without_zone(clean_to_analytic(spec, rows))

    @registry.add(f"analytic_{spec.name}_increment", _analytic_sql(spec, newer))
    def analytic_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = raw_to_clean(spec, documents(spark, sf_dir))
        history = _analytic_history(spark, sf_dir)
        return without_zone(clean_to_analytic(spec, rows, history))


for _spec in FEEDS.values():
    _register(_spec)


@registry.add("json_text_daily", clean_sql("daily"))
def _json_text_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON text in a column, parsed once by the job that fills the layer."""
    columns = F.struct(*DAILY.raw_columns)
    text = documents(spark, sf_dir).select(F.to_json(columns).alias("text"))
    parsed = parse_raw(text, F.col("text"), needed_schema([DAILY], DOCUMENT_SCHEMA))
    clean = staging_path(spark, "clean")
    run_raw_to_clean(parsed, clean, [DAILY], compacted=True)
    return without_zone(read_layer(spark, layer_path(clean, DAILY)))


def _json_files(spark: SparkSession, spec: FeedSpec, rows: DataFrame) -> str:
    """Documents in a directory of JSON files, without the arrays of other feeds."""
    path = staging_path(spark, "raw-json")
    documents_of(spread(rows)).select(*spec.raw_columns).write.options(**RAW_FILES).json(path)
    return path


@registry.add("json_scan_hourly", clean_sql("hourly"))
def _json_scan_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in JSON files, read by a declared schema."""
    path = _json_files(spark, HOURLY, events(spark, sf_dir))
    raw = read_raw(spark, path, needed_schema([HOURLY], DOCUMENT_SCHEMA))
    return without_zone(raw_to_clean(HOURLY, raw))


@registry.add("json_scan_inferred_current", clean_sql("current"))
def _json_scan_inferred_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in JSON files whose schema Spark infers."""
    path = _json_files(spark, CURRENT, events(spark, sf_dir))
    return without_zone(raw_to_clean(CURRENT, read_raw(spark, path, None)))


def _stored_hops(spec: FeedSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both hops twice through JSON files and stored layers: first with the processed
    documents, then with all of them; returns what the second run left in the last layer."""
    clean, analytic = staging_path(spark, "clean"), staging_path(spark, "analytic")
    rows = events(spark, sf_dir)
    history: tuple[dict, dict] = ({}, {})
    for batch in (_processed(rows), rows):
        path = _json_files(spark, spec, batch)
        raw = read_raw(spark, path, needed_schema([spec], DOCUMENT_SCHEMA))
        run_raw_to_clean(raw, clean, [spec], history[0], compacted=True)
        run_clean_to_analytic(spark, clean, analytic, [spec], history[1], compacted=True)
        history = (
            {spec.name: read_layer(spark, layer_path(clean, spec))},
            {spec.name: read_layer(spark, layer_path(analytic, spec))},
        )
    return without_zone(read_layer(spark, layer_path(analytic, spec)))


@registry.add("stored_hops_current", _analytic_sql(CURRENT, f"s > {_newest_sql()}"))
def _stored_hops_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_hops(CURRENT, spark, sf_dir)


def _newest_with_elements_sql(feed: str) -> str:
    """An observation without elements leaves no clean row, so it cannot be the mark."""
    processed = clean_sql(feed, f"ts < TIMESTAMP '{CUTOFF}'")
    return f"(SELECT max(current_dt) FROM ({processed}))"


@registry.add(
    "stored_hops_hourly", _analytic_sql(HOURLY, f"s > {_newest_with_elements_sql('hourly')}")
)
def _stored_hops_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_hops(HOURLY, spark, sf_dir)


@registry.add(
    "stored_hops_minutely",
    _analytic_sql(MINUTELY, f"s > {_newest_with_elements_sql('minutely')}"),
)
def _stored_hops_minutely(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_hops(MINUTELY, spark, sf_dir)


@registry.add(
    "stream_clean_current",
    clean_sql("current", columns="CASE WHEN k % 11 <> 0 THEN '[]' END AS current_weather_more"),
)
def _stream_clean_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in JSON files, taken up as a stream that ends with what is there."""
    path = _json_files(spark, CURRENT, events(spark, sf_dir))
    schema = needed_schema([CURRENT], DOCUMENT_SCHEMA)
    layer, checkpoint = staging_path(spark, "streamed"), staging_path(spark, "progress")
    rows = clean_stream(replace(CURRENT, weather_width=2), read_raw_stream(spark, path, schema))
    start_layer(rows, layer, checkpoint).awaitTermination()
    stored = read_layer(spark, layer, rows.schema)
    return without_zone(stored.withColumn("current_weather_more", F.to_json("current_weather_more")))


@registry.add(
    "clean_minutely_high_precision",
    f"""
    SELECT * EXCLUDE (time_precipitation_amt_precipitation, exact),
           exact AS time_precipitation_amt_precipitation
    FROM ({clean_sql("minutely", columns="v * 0.125 - i AS exact")})
    """,
)
def _clean_minutely_high_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_zone(raw_to_clean(high_precision(MINUTELY), documents(spark, sf_dir)))


@registry.add(
    "clean_minutely_dedupe",
    f"""
    SELECT DISTINCT * FROM ({clean_sql("minutely")})
    """,
)
def _clean_minutely_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents twice, without the copies."""
    raw = documents(spark, sf_dir)
    return without_zone(raw_to_clean(MINUTELY, raw.unionAll(raw), dedupe=True))


@registry.add(
    "analytic_hourly_lookback_dedupe",
    f"SELECT DISTINCT * FROM ({_analytic_sql(HOURLY, f's > {_newest_sql()} - 86400')})",
)
def _analytic_hourly_lookback_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of clean rows, all of them twice, read again without the copies."""
    rows = raw_to_clean(HOURLY, documents(spark, sf_dir))
    history = _analytic_history(spark, sf_dir)
    return without_zone(clean_to_analytic(HOURLY, rows.unionAll(rows), history, 86400, True))


def _condition_sql(i: int) -> str:
    own = f'"daily_weather_forecast_weather[{i}]_'
    return (f"""'{{"id":' || {own}id" || ',"main":"' || {own}main" || '","description":"' """
            f"""|| {own}description" || '","icon":"' || {own}icon" || '"}}'""")


_BEYOND = ", ".join(f'"daily_weather_forecast_weather[{i}]_{name}"'
                    for i in (1, 2) for name in ("id", "main", "description", "icon"))


@registry.add(
    "clean_daily_fixed_width",
    f"""
    SELECT * EXCLUDE (filled, {_BEYOND}),
           CASE WHEN filled THEN '[' || concat_ws(',', {_condition_sql(1)}, {_condition_sql(2)}) || ']' END
               AS daily_weather_forecast_weather_more
    FROM ({clean_sql("daily", columns="k % 7 <> 1 AS filled")})
    """,
)
def _clean_daily_fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns for one condition, and the others whole in an array."""
    rows = raw_to_clean(replace(DAILY, weather_width=1), documents(spark, sf_dir))
    more = "daily_weather_forecast_weather_more"
    return without_zone(rows.withColumn(more, F.to_json(more)))


@registry.add(
    "clean_current_per_place",
    f"""
    WITH clean AS ({clean_sql("current", columns="ts")}),
    marks AS (SELECT lat, lon, max(current_dt) AS mark FROM clean
              WHERE ts < TIMESTAMP '{CUTOFF}' GROUP BY lat, lon)
    SELECT clean.* EXCLUDE (ts) FROM clean LEFT JOIN marks USING (lat, lon)
    WHERE current_dt > coalesce(mark, 0)
    """,
)
def _clean_current_per_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each place measured by its own history."""
    rows = events(spark, sf_dir)
    history = raw_to_clean(CURRENT, documents_of(_processed(rows)))
    place = ("lat", "lon")
    return without_zone(raw_to_clean(CURRENT, documents_of(rows), history, keys=place))
