"""Layers that grow run by run: batches of other widths, corrections, late rows, marks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.feeds import (
    CURRENT,
    CURRENT_DT,
    DAILY,
    DATE_PARTITION,
    HOURLY,
    WEATHER_TIME,
    FeedSpec,
    needed_fields,
    needed_schema,
)
from tidemark.plans.jobs import layer_path, run_clean_to_analytic, run_raw_to_clean
from tidemark.plans.pipelines import clean_mark, raw_to_clean
from tidemark.sources.documents import landed
from tidemark.sources.layers import Layer, Table, read_layer
from tidemark.sources.readers import read_raw
from tidemark.sources.staging import staging_path
from tidemark.streaming import analytic_stream, clean_stream, read_layer_stream, read_raw_stream, start_layer
from tidemark.workload.feed_queries import (
    _analytic_sql,
    _json_files,
    _newest_with_elements_sql,
    _processed,
    _stored_hops,
)
from tidemark.workload.inputs import (
    CUTOFF,
    DOCUMENT_SCHEMA,
    RAW_FILES,
    clean_sql,
    documents_of,
    events,
    spread,
)
from tidemark.workload.registry import Registry, without_zone

registry = Registry()


class _Growing:
    """Both layers of one feed, filled batch by batch."""

    def __init__(self, spark: SparkSession, spec: FeedSpec) -> None:
        self.spark, self.spec = spark, spec
        self.clean, self.analytic = staging_path(spark, "clean"), staging_path(spark, "analytic")

    def layer(self, root: str) -> Layer:
        return Layer(self.spark, layer_path(root, self.spec), DATE_PARTITION)

    def take(self, rows: DataFrame, marked: bool = True, keys: Sequence[str] = ()) -> None:
        """Documents of ``rows``, through JSON files whose schema is inferred, to both layers."""
        path = _json_files(self.spark, self.spec, rows)
        found = read_raw(self.spark, path, None).schema
        raw = read_raw(self.spark, path, needed_schema([self.spec], found))
        history = {self.spec.name: self.layer(self.clean)} if marked else {}
        run_raw_to_clean(raw, self.clean, [self.spec], history, "touched", True, keys=keys, log=8)
        run_clean_to_analytic(self.spark, self.clean, self.analytic, [self.spec], by="changes")

    def rows(self, root: str) -> DataFrame:
        return without_zone(read_layer(self.spark, layer_path(root, self.spec)))


_BATCH = "CASE WHEN k % 3 = 2 THEN 2 WHEN event_id % 2 = 0 THEN 1 ELSE 3 END"


@registry.add(
    "stored_mixed_widths_current",
    f"""
    SELECT * EXCLUDE (batch) FROM ({_analytic_sql(CURRENT).replace(
        clean_sql("current"), clean_sql("current", columns=f"{_BATCH} AS batch"))})
    QUALIFY batch = max(batch) OVER (PARTITION BY lat, lon, current_weather_time)
    """,
)
def _stored_mixed_widths_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over the same dates, of which only the second has second conditions."""
    layers, rows = _Growing(spark, CURRENT), events(spark, sf_dir).withColumn("batch", F.expr(_BATCH))
    for batch in (1, 2, 3):
        layers.take(rows.where(F.col("batch") == batch), marked=False)
    return layers.rows(layers.analytic)


_WINDOW = f"{_newest_with_elements_sql('hourly')} - {HOURLY.lookback}"


@registry.add(
    "stored_merge_hourly",
    f"""
    {clean_sql("hourly", f"ts < TIMESTAMP '{CUTOFF}' AND s <= {_WINDOW}")}
    UNION ALL BY NAME
    SELECT * FROM ({clean_sql("hourly", "s > bound", "bound").replace("value AS v", "value + 1 AS v").replace(
        "FROM events\n)", f"FROM events, (SELECT {_WINDOW} AS bound)\n)")})
    """.replace("SELECT * FROM (", "SELECT * EXCLUDE (bound) FROM (", 1),
)
def _stored_merge_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come again with other values; those within the look-back replace rows."""
    layers, rows = _Growing(spark, HOURLY), events(spark, sf_dir)
    layers.take(_processed(rows))
    layers.take(rows.withColumn("v", F.col("v") + 1))
    return layers.rows(layers.clean)


_LATE = "event_id % 10 = 3"
_FIRST = f"ts < TIMESTAMP '{CUTOFF}' AND NOT {_LATE}"


@registry.add(
    "stored_late_hourly",
    _analytic_sql(
        HOURLY,
        f"(({_FIRST}) OR s > (SELECT max(current_dt) FROM ({clean_sql('hourly', _FIRST)})) - {HOURLY.lookback})",
    ),
)
def _stored_late_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents come late; those within the look-back reach the analytic layer
    through the log of changes, though newer rows are there already."""
    layers, rows = _Growing(spark, HOURLY), events(spark, sf_dir)
    layers.take(_processed(rows).where(f"NOT {_LATE}"))
    layers.take(rows)
    return layers.rows(layers.analytic)


@registry.add("stored_hops_per_place", _analytic_sql(CURRENT))
def _stored_hops_per_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the places report nothing until the second run; none of their rows is lost,
    and none of the others' comes twice."""
    layers, rows = _Growing(spark, CURRENT), events(spark, sf_dir)
    # Places, not users, are late: several users share a place.
    late = "(user_id % 180 - 90 + 200) % 5 = 0"
    layers.take(_processed(rows).where(f"NOT {late}"), keys=("lat", "lon"))
    layers.take(rows, keys=("lat", "lon"))
    return layers.rows(layers.analytic)


@registry.add("stored_hops_daily", _analytic_sql(DAILY, f"s > {_newest_with_elements_sql('daily')}"))
def _stored_hops_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_hops(DAILY, spark, sf_dir)


def _mark(spark: SparkSession, value: int, rows: int) -> DataFrame:
    return spark.createDataFrame([(value, rows)], f"{CURRENT_DT} int, n_rows long")


_MARK_SQL = f"SELECT max(current_dt) AS current_dt, count(*) AS n_rows FROM ({clean_sql('current')})"


@registry.add("hwm_by_partition", _MARK_SQL)
def _hwm_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark of a stored layer, found from its folders."""
    layers = _Growing(spark, CURRENT)
    layers.take(events(spark, sf_dir))
    layer = layers.layer(layers.clean)
    return _mark(spark, clean_mark(layer), layer.read().count())


@registry.add("hwm_catalog_table", _MARK_SQL)
def _hwm_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark of a table in a database of its own, filled by two appends of other widths."""
    table = Table(spark, "current", DATE_PARTITION, f"layer_{uuid.uuid4().hex}")
    rows = events(spark, sf_dir)
    try:
        for some in ("k % 3 < 2", "k % 3 = 2"):
            table.append(raw_to_clean(CURRENT, documents_of(rows.where(some))))
        return _mark(spark, clean_mark(table), table.read().count())
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{table.database}` CASCADE")


@registry.add(
    "stream_analytic_current",
    f"""
    SELECT * EXCLUDE ("current_weather[1]_id", "current_weather[1]_main", "current_weather[1]_description", "current_weather[1]_icon", more),
           CASE WHEN more AND "current_weather[1]_id" IS NULL THEN '[]' WHEN more THEN
               '[{{"id":' || "current_weather[1]_id" || ',"main":"' || "current_weather[1]_main" || '","description":"'
               || "current_weather[1]_description" || '","icon":"' || "current_weather[1]_icon" || '"}}]' END AS current_weather_more
    FROM ({_analytic_sql(CURRENT).replace(clean_sql("current"), clean_sql("current", columns="k % 11 <> 0 AS more"))})
    """,
)
def _stream_analytic_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both hops as streams: the second reads the files that the first adds to its layer."""
    path = _json_files(spark, CURRENT, events(spark, sf_dir))
    clean, analytic = staging_path(spark, "streamed-clean"), staging_path(spark, "streamed-analytic")
    rows = clean_stream(CURRENT, read_raw_stream(spark, path, DOCUMENT_SCHEMA))
    start_layer(rows, clean, staging_path(spark, "progress")).awaitTermination()
    again = analytic_stream(CURRENT, read_layer_stream(spark, clean))
    start_layer(again, analytic, staging_path(spark, "progress")).awaitTermination()
    stored = read_layer(spark, analytic)
    return without_zone(stored.withColumn("current_weather_more", F.to_json("current_weather_more")))


# --- Documents beyond the declared schema -------------------------------------------------------


def _json_lines(spark: SparkSession, spec: FeedSpec, rows: DataFrame,
                change: Callable[[DataFrame], DataFrame], spell: Callable[[Column], Column] | None = None) -> DataFrame:
    """Documents as lines of JSON files, after ``change`` of the documents and ``spell`` of the
    text. ``k`` is at hand for both."""
    documents = documents_of(spread(rows)).select(*spec.raw_columns, F.expr("current.humidity").alias("k"))
    text = F.to_json(F.struct(*(F.col(name) for name in spec.raw_columns)))
    lines = change(documents).select((text if spell is None else spell(text)).alias("value"))
    path = staging_path(spark, "json-lines")
    lines.write.options(**RAW_FILES).text(path)
    return spark.read.text(path)


def _landed(spark: SparkSession, spec: FeedSpec, batches: Sequence[DataFrame]) -> DataFrame:
    """The clean layer that batches of lines grow to, by a schema that is learnt on the way."""
    clean, store = staging_path(spark, "clean"), staging_path(spark, "schema") + "/raw.json"
    for lines in batches:
        with landed(lines, DOCUMENT_SCHEMA, store, needed_fields([spec])) as batch:
            run_raw_to_clean(batch.documents, clean, [spec], overwrite="touched", compacted=True)
    return without_zone(read_layer(spark, layer_path(clean, spec)))


@registry.add(
    "json_scan_unknown_fields",
    clean_sql("daily", columns="""
        v * 0.75 * 2 AS daily_weather_forecast_wind_speed,
        v + i + 1 AS daily_weather_forecast_temp_max,
        CASE WHEN k % 2 = 0 THEN 'a' || k END AS daily_weather_forecast_summary"""),
)
def _json_scan_unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that the documented schema does not have, on two levels, some in half of the rows."""

    def more(day: Column) -> Column:
        day = day.withField("wind_speed", day["rain"] * 2).withField("temp.max", day["temp"]["day"] + 1)
        return day.withField("summary", F.when(F.col("k") % 2 == 0, F.concat(F.lit("a"), F.col("k"))))

    lines = _json_lines(spark, DAILY, events(spark, sf_dir), lambda df: df.withColumn("daily", F.transform("daily", more)))
    return _landed(spark, DAILY, [lines])


@registry.add("json_scan_mixed_numbers", clean_sql("current"))
def _json_scan_mixed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers spelled with a fraction of zero or as text, in some of the documents."""

    def spell(text: Column) -> Column:
        text = F.when(F.col("k") % 2 == 0, F.regexp_replace(text, r'"(dt|pressure)":(-?\d+)', r'"$1":$2.0')).otherwise(text)
        return F.when(F.col("k") % 3 == 0, F.regexp_replace(text, r'"(humidity|wind_deg)":(-?\d+)', r'"$1":"$2"')).otherwise(text)

    return _landed(spark, CURRENT, [_json_lines(spark, CURRENT, events(spark, sf_dir), lambda df: df, spell)])


_DAY, _MORE = "daily_weather_forecast_temp_day", "daily_weather_forecast_weather_more"
_OTHERS = ", ".join(f'"daily_weather_forecast_weather[{i}]_{name}"' for i in (1, 2) for name in ("id", "main", "description", "icon"))


def _condition_sql(i: int) -> str:
    own = f'"daily_weather_forecast_weather[{i}]_'
    return f"""'{{"id":' || CAST({own}id" AS DOUBLE) || ',"main":"' || {own}main" || '","description":"' || {own}description" || '","icon":"' || {own}icon" || '"}}'"""


@registry.add(
    "json_scan_nested_variants",
    f"""
    SELECT * EXCLUDE ({_DAY}, day, filled, {_OTHERS}), day AS {_DAY},
           CASE WHEN filled THEN '[' || concat_ws(',', {_condition_sql(1)}, {_condition_sql(2)}) || ']' END AS {_MORE}
    FROM ({clean_sql("daily", columns="CASE WHEN k % 2 = 1 THEN v + i ELSE CAST(k AS DOUBLE) END AS day, k % 7 <> 1 AS filled")})
    """,
)
def _json_scan_nested_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants below a struct, and within an array that stays one."""

    def vary(day: Column) -> Column:
        odd = F.col("k") % 2 == 1
        day = day.withField("temp.day", F.struct(F.when(~odd, F.col("k")).alias("int"), F.when(odd, day["temp"]["day"]).alias("double")))

        def numbered(weather: Column) -> Column:
            number = F.struct(F.when(odd, weather["id"]).alias("int"), F.when(~odd, weather["id"] + F.lit(0.0)).alias("double"))
            return weather.withField("id", number)

        return day.withField("weather", F.transform(day["weather"], numbered))

    lines = _json_lines(spark, DAILY, events(spark, sf_dir), lambda df: df.withColumn("daily", F.transform("daily", vary)))
    rows = _landed(spark, replace(DAILY, weather_width=1), [lines])
    names = [f for f in rows.schema[_MORE].dataType.elementType.names]
    ordered = F.transform(_MORE, lambda w: F.struct(*(w[name].alias(name) for name in ("id", "main", "description", "icon") if name in names)))
    return rows.withColumn(_MORE, F.to_json(ordered))


@registry.add(
    "json_scan_growing_schema",
    clean_sql("current", columns="""
        CASE WHEN k % 2 = 0 THEN v * 0.5 END AS current_rain_1h,
        CASE WHEN k % 2 = 1 THEN k + 1 END AS current_snow_depth"""),
)
def _json_scan_growing_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, each with a field that the other lacks; the layer has both."""

    def rain(df: DataFrame) -> DataFrame:
        return df.withColumn("current", F.col("current").withField("rain", F.struct((F.col("current.dew_point")).alias("1h"))))

    def snow(df: DataFrame) -> DataFrame:
        return df.withColumn("current", F.col("current").withField("snow", F.struct((F.col("k") + 1).alias("depth"))))

    rows = events(spark, sf_dir)
    batches = [_json_lines(spark, CURRENT, rows.where("k % 2 = 0"), rain), _json_lines(spark, CURRENT, rows.where("k % 2 = 1"), snow)]
    layer = _landed(spark, CURRENT, batches)
    return layer.withColumn("current_snow_depth", F.col("current_snow_depth").cast("int"))
