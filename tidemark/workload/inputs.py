"""Nested documents derived from the ``events`` table.

Every event is one document, so building them needs no grouping: their arrays have 0 to 6
elements, or are NULL, by arithmetic on the event. :func:`clean_sql` states what comes of them
in SQL, where nothing is ever nested."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.feeds import raw_schema
from tidemark.session import configure

#: Leaves that arrive as ``struct<int, double>`` in these documents.
VARIANTS = ("temp", "wind_gust")
DOCUMENT_SCHEMA = raw_schema(VARIANTS)

#: How JSON files are written: compressed, as raw data lands, which moves a fifth of the bytes. Such
#: a file is read by one task, so none gets large.
RAW_FILES = {"compression": "lz4", "maxRecordsPerFile": "10000"}

#: Events before this moment count as processed in the queries on increments.
CUTOFF = "2024-01-16 12:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables, in a session with pinned time zone."""
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with its epoch second ``s``, a small number ``k`` and its value ``v``."""
    return table(spark, sf_dir, "events").selectExpr(
        "*",
        "CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS INT) AS s",
        "CAST(event_id % 100 AS INT) AS k",
        "value AS v",
    )


def spread(rows: DataFrame) -> DataFrame:
    """Some of the :func:`events`, dealt over all cores: their file has few row groups, and documents
    many times their size are made of them. Neighbours, which are of one time, stay together."""
    return rows.repartitionByRange("event_id")


EVENTS_CTE = """e AS (
    SELECT *, CAST(floor(epoch(ts)) AS INTEGER) AS s, CAST(event_id % 100 AS INTEGER) AS k,
           value AS v
    FROM events
)"""


def _elements(length: str, null_if: str, element: str, i: str = "i") -> str:
    """Array of ``element`` for ``i`` from 0 up to ``length``; NULL where ``null_if``."""
    steps = f"slice(array(0, 1, 2, 3, 4, 5, 6), 1, {length})"
    return f"CASE WHEN NOT {null_if} THEN transform({steps}, {i} -> {element}) END"


def _weather(number: str, length: str, null_if: str) -> str:
    element = f"""named_struct(
        'id', {number} + j + 200,
        'main', event_type,
        'description', concat(event_type, ' ', {number}),
        'icon', concat({number} + j, 'd'))"""
    return _elements(length, null_if, element, "j")


_CURRENT = f"""named_struct(
    'dt', s,
    'sunrise', s - s % 86400 + 21600,
    'sunset', s - s % 86400 + 64800,
    'temp', named_struct('int', if(k % 4 = 0, k, NULL), 'double', if(k % 4 = 1, v, NULL)),
    'feels_like', v - 1.5D,
    'pressure', k + 900,
    'humidity', k,
    'dew_point', v / 2,
    'uvi', k * 0.25D,
    'clouds', 100 - k,
    'visibility', k * 100,
    'wind_speed', v * 0.25D,
    'wind_deg', k * 3,
    'wind_gust', named_struct('int', if(k % 3 = 0, k * 2, NULL),
                              'double', if(k % 2 = 0, v + 1, NULL)),
    'weather', {_weather("k", "k % 3", "(k % 11 = 0)")})"""

_MINUTE = """named_struct(
    'dt', s - s % 60 + (i + 1) * 60,
    'precipitation', v * 0.125D - i)"""

_HOUR = f"""named_struct(
    'dt', s - s % 3600 + (i + 1) * 3600,
    'temp', named_struct('int', if((k + i) % 2 = 0, k + i, NULL),
                         'double', if((k + i) % 3 = 0, v + i, NULL)),
    'feels_like', v - 3.25D - i * 4,
    'pressure', k + i + 900,
    'humidity', k,
    'dew_point', v / 4,
    'uvi', i * 0.5D,
    'clouds', 100 - k,
    'visibility', k * 100 + i,
    'wind_speed', v * 0.5D,
    'wind_deg', (k * 3 + i) % 360,
    'wind_gust', named_struct('int', if(k % 5 = 0, k + 7, NULL),
                              'double', if(k % 5 = 1, v * 2, NULL)),
    'pop', k * 0.01D,
    'rain', if((k + i) % 2 = 0, named_struct('1h', v * 0.0625D), NULL),
    'weather', {_weather("(k + i)", "(k + i) % 3", "(k % 7 = 0)")})"""

_DAY = f"""named_struct(
    'dt', s - s % 86400 + (i + 1) * 86400,
    'sunrise', s - s % 86400 + 21600 + i * 60,
    'sunset', s - s % 86400 + 64800 - i * 60,
    'moonrise', s - s % 86400 + 70000 + i,
    'moonset', s - s % 86400 + 30000 + i,
    'moon_phase', i * 0.125D,
    'temp', named_struct('day', v + i, 'min', v - 5, 'morn', v - 2, 'eve', v / 3,
                         'night', v / 7),
    'feels_like', named_struct('day', v + i + 1, 'night', v - 6, 'morn', v - 3, 'eve', v - 1),
    'pressure', k + 900,
    'humidity', k,
    'dew_point', v / 5,
    'wind_deg', k * 3,
    'wind_gust', named_struct('int', if(k % 5 = 0, k + 9, NULL),
                              'double', if(k % 5 = 1, v * 3, NULL)),
    'clouds', 100 - k,
    'rain', v * 0.75D,
    'uvi', v / 9,
    'pop', k / 100D,
    'weather', {_weather("(k + i)", "(k + i) % 4", "(k % 7 = 1)")})"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw document per event, of type :data:`DOCUMENT_SCHEMA`."""
    return documents_of(events(spark, sf_dir))


def documents_of(rows: DataFrame) -> DataFrame:
    """Raw documents of some of the :func:`events`."""
    return rows.selectExpr(
        "CAST(user_id % 180 - 90 AS DOUBLE) AS lat",
        "CAST(user_id * 7 % 360 - 180 AS DOUBLE) AS lon",
        "concat('Zone/', event_type) AS timezone",
        "(k % 25 - 12) * 3600 AS timezone_offset",
        f"{_CURRENT} AS current",
        f"{_elements('k % 7', '(k % 13 = 0)', _MINUTE)} AS minutely",
        f"{_elements('k % 5', '(k % 17 = 0)', _HOUR)} AS hourly",
        f"{_elements('k % 4', '(k % 19 = 0)', _DAY)} AS daily",
    )


#: Condition under which element ``i`` of an array exists, by feed.
ELEMENTS_SQL = {
    "minutely": "i < k % 7 AND k % 13 <> 0",
    "hourly": "i < k % 5 AND k % 17 <> 0",
    "daily": "i < k % 4 AND k % 19 <> 0",
}

_WEATHER_SQL = """
    CASE WHEN {some} THEN {number} + {j} + 200 END AS "{prefix}_id",
    CASE WHEN {some} THEN event_type END AS "{prefix}_main",
    CASE WHEN {some} THEN event_type || ' ' || {number} END AS "{prefix}_description",
    CASE WHEN {some} THEN ({number} + {j}) || 'd' END AS "{prefix}_icon"
"""


def _weather_sql(prefix: str, number: str, length: str, null_if: str, longest: int) -> str:
    """Columns of all conditions, of which an array has ``longest`` at most."""
    return ", ".join(
        _WEATHER_SQL.format(some=f"({length} > {j} AND NOT {null_if})", number=f"({number})",
                            prefix=f"{prefix}_weather[{j}]", j=j)
        for j in range(longest)
    )


_LOCATION_SQL = """
    CAST(user_id % 180 - 90 AS DOUBLE) AS lat,
    CAST(user_id * 7 % 360 - 180 AS DOUBLE) AS lon,
    'Zone/' || event_type AS timezone,
    CAST((k % 25 - 12) * 3600 AS INTEGER) AS timezone_offset,
    s AS current_dt,
    CAST(to_timestamp(s) AT TIME ZONE 'UTC' AS TIMESTAMP) AS current_weather_time,
    CAST(to_timestamp(s) AT TIME ZONE 'UTC' AS DATE) AS current_weather_date,
    CAST(to_timestamp(s) AT TIME ZONE 'UTC' AS DATE) AS current_weather_date_partition
"""

_CURRENT_SQL = f"""
    s - s % 86400 + 21600 AS current_sunrise,
    s - s % 86400 + 64800 AS current_sunset,
    CASE WHEN k % 4 = 1 THEN v WHEN k % 4 = 0 THEN CAST(k AS DOUBLE) END AS current_temp,
    v - 1.5 AS current_feels_like,
    k + 900 AS current_pressure,
    k AS current_humidity,
    v / 2 AS current_dew_point,
    k * CAST(0.25 AS DOUBLE) AS current_uvi,
    100 - k AS current_clouds,
    k * 100 AS current_visibility,
    v * 0.25 AS current_wind_speed,
    k * 3 AS current_wind_deg,
    CASE WHEN k % 2 = 0 THEN v + 1 WHEN k % 3 = 0 THEN CAST(k * 2 AS DOUBLE) END
        AS current_wind_gust,
    {_weather_sql("current", "k", "k % 3", "k % 11 = 0", 2)}
"""

_MINUTELY_SQL = """
    s - s % 60 + (i + 1) * 60 AS time_precipitation_amt_dt,
    CAST(trunc(v * 0.125 - i) AS INTEGER) AS time_precipitation_amt_precipitation
"""

_HOURLY_SQL = f"""
    s - s % 3600 + (i + 1) * 3600 AS hourly_weather_forecast_dt,
    CASE WHEN (k + i) % 3 = 0 THEN v + i WHEN (k + i) % 2 = 0 THEN CAST(k + i AS DOUBLE) END
        AS hourly_weather_forecast_temp,
    CAST(trunc(v - 3.25 - i * 4) AS INTEGER) AS hourly_weather_forecast_feels_like,
    k + i + 900 AS hourly_weather_forecast_pressure,
    k AS hourly_weather_forecast_humidity,
    v / 4 AS hourly_weather_forecast_dew_point,
    i * CAST(0.5 AS DOUBLE) AS hourly_weather_forecast_uvi,
    100 - k AS hourly_weather_forecast_clouds,
    k * 100 + i AS hourly_weather_forecast_visibility,
    v * 0.5 AS hourly_weather_forecast_wind_speed,
    (k * 3 + i) % 360 AS hourly_weather_forecast_wind_deg,
    CASE WHEN k % 5 = 1 THEN v * 2 WHEN k % 5 = 0 THEN CAST(k + 7 AS DOUBLE) END
        AS hourly_weather_forecast_wind_gust,
    k * CAST(0.01 AS DOUBLE) AS hourly_weather_forecast_pop,
    CASE WHEN (k + i) % 2 = 0 THEN v * 0.0625 END AS hourly_weather_forecast_rain_1h,
    {_weather_sql("hourly_weather_forecast", "k + i", "(k + i) % 3", "k % 7 = 0", 2)}
"""

_DAILY_SQL = f"""
    s - s % 86400 + (i + 1) * 86400 AS daily_weather_forecast_dt,
    s - s % 86400 + 21600 + i * 60 AS daily_weather_forecast_sunrise,
    s - s % 86400 + 64800 - i * 60 AS daily_weather_forecast_sunset,
    s - s % 86400 + 70000 + i AS daily_weather_forecast_moonrise,
    s - s % 86400 + 30000 + i AS daily_weather_forecast_moonset,
    i * CAST(0.125 AS DOUBLE) AS daily_weather_forecast_moon_phase,
    v + i AS daily_weather_forecast_temp_day,
    v - 5 AS daily_weather_forecast_temp_min,
    v - 2 AS daily_weather_forecast_temp_morn,
    CAST(v / 3 AS FLOAT) AS daily_weather_forecast_temp_eve,
    CAST(v / 7 AS FLOAT) AS daily_weather_forecast_temp_night,
    v + i + 1 AS daily_weather_forecast_feels_like_day,
    v - 6 AS daily_weather_forecast_feels_like_night,
    v - 3 AS daily_weather_forecast_feels_like_morn,
    v - 1 AS daily_weather_forecast_feels_like_eve,
    k + 900 AS daily_weather_forecast_pressure,
    k AS daily_weather_forecast_humidity,
    CAST(v / 5 AS FLOAT) AS daily_weather_forecast_dew_point,
    k * 3 AS daily_weather_forecast_wind_deg,
    CASE WHEN k % 5 = 1 THEN v * 3 WHEN k % 5 = 0 THEN CAST(k + 9 AS DOUBLE) END
        AS daily_weather_forecast_wind_gust,
    100 - k AS daily_weather_forecast_clouds,
    v * 0.75 AS daily_weather_forecast_rain,
    CAST(v / 9 AS FLOAT) AS daily_weather_forecast_uvi,
    CAST(k / CAST(100 AS DOUBLE) AS FLOAT) AS daily_weather_forecast_pop,
    {_weather_sql("daily_weather_forecast", "k + i", "(k + i) % 4", "k % 7 = 1", 3)}
"""

_OWN_SQL = {
    "current": _CURRENT_SQL,
    "daily": _DAILY_SQL,
    "hourly": _HOURLY_SQL,
    "minutely": _MINUTELY_SQL,
}


def clean_sql(feed: str, where: str = "true", columns: str | None = None) -> str:
    """The clean layer of a feed, stated flat over ``events``, with ``columns`` besides."""
    steps = "" if feed == "current" else ", (SELECT CAST(range AS INTEGER) AS i FROM range(7))"
    exists = ELEMENTS_SQL.get(feed, "true")
    return f"""
    WITH {EVENTS_CTE}
    SELECT {_LOCATION_SQL}, {_OWN_SQL[feed]}{"" if columns is None else f", {columns}"}
    FROM e{steps}
    WHERE {exists} AND {where}
    """
