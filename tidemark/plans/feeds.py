"""The four feeds as declarations: raw schema, official types, names, order."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Literal

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

SECONDS_PER_DAY = 86400

# --- Fixed values: names that hold for all feeds and both layers ----------------------------

OBSERVATION = "current"
OBSERVATION_DT = "dt"
OBSERVATION_EPOCH = f"{OBSERVATION}.{OBSERVATION_DT}"
LOCATION = ("lat", "lon", "timezone", "timezone_offset")
CURRENT_DT = "current_dt"
WEATHER_TIME = "current_weather_time"
WEATHER_DATE = "current_weather_date"
DATE_PARTITION = "current_weather_date_partition"
TIME_PREFIX = "current_weather"

# --- Fixed values: column types of the clean layer ------------------------------------------

_COMMON_TYPES = {
    "lat": "double",
    "lon": "double",
    "timezone": "string",
    "timezone_offset": "integer",
    "current_dt": "integer",
}

CURRENT_TYPES = _COMMON_TYPES | {
    "current_sunrise": "integer",
    "current_sunset": "integer",
    "current_temp": "double",
    "current_feels_like": "double",
    "current_pressure": "integer",
    "current_humidity": "integer",
    "current_dew_point": "double",
    "current_clouds": "integer",
    "current_visibility": "integer",
    "current_wind_speed": "double",
    "current_wind_deg": "integer",
    "current_wind_gust": "double",
    "current_weather[0]_id": "integer",
    "current_weather[0]_main": "string",
    "current_weather[0]_description": "string",
    "current_weather[0]_icon": "string",
    "current_uvi": "double",
}

DAILY_TYPES = _COMMON_TYPES | {
    "daily_weather_forecast_dt": "integer",
    "daily_weather_forecast_sunrise": "integer",
    "daily_weather_forecast_sunset": "integer",
    "daily_weather_forecast_moonrise": "integer",
    "daily_weather_forecast_moonset": "integer",
    "daily_weather_forecast_moon_phase": "double",
    "daily_weather_forecast_temp_day": "double",
    "daily_weather_forecast_temp_min": "double",
    "daily_weather_forecast_feels_like_day": "double",
    "daily_weather_forecast_feels_like_night": "double",
    "daily_weather_forecast_feels_like_morn": "double",
    "daily_weather_forecast_temp_morn": "double",
    "daily_weather_forecast_pressure": "integer",
    "daily_weather_forecast_humidity": "integer",
    "daily_weather_forecast_wind_deg": "integer",
    "daily_weather_forecast_wind_gust": "double",
    "daily_weather_forecast_clouds": "integer",
    "daily_weather_forecast_rain": "double",
    "daily_weather_forecast_weather[0]_id": "integer",
    "daily_weather_forecast_weather[0]_main": "string",
    "daily_weather_forecast_weather[0]_description": "string",
    "daily_weather_forecast_weather[0]_icon": "string",
    "daily_weather_forecast_uvi": "float",
    "daily_weather_forecast_temp_eve": "float",
    "daily_weather_forecast_feels_like_eve": "double",
    "daily_weather_forecast_pop": "float",
    "daily_weather_forecast_temp_night": "float",
    "daily_weather_forecast_dew_point": "float",
}

HOURLY_TYPES = _COMMON_TYPES | {
    "hourly_weather_forecast_dt": "integer",
    "hourly_weather_forecast_feels_like": "integer",
    "hourly_weather_forecast_pressure": "integer",
    "hourly_weather_forecast_humidity": "integer",
    "hourly_weather_forecast_clouds": "integer",
    "hourly_weather_forecast_visibility": "integer",
    "hourly_weather_forecast_wind_deg": "integer",
    "hourly_weather_forecast_wind_speed": "double",
    "hourly_weather_forecast_dew_point": "double",
    "hourly_weather_forecast_wind_gust": "double",
    "hourly_weather_forecast_temp": "double",
    "hourly_weather_forecast_uvi": "double",
    "hourly_weather_forecast_pop": "double",
    "hourly_weather_forecast_weather[0]_id": "integer",
    "hourly_weather_forecast_weather[0]_main": "string",
    "hourly_weather_forecast_weather[0]_description": "string",
    "hourly_weather_forecast_weather[0]_icon": "string",
    "hourly_weather_forecast_rain_1h": "double",
}

MINUTELY_TYPES = _COMMON_TYPES | {
    "time_precipitation_amt_dt": "integer",
    "time_precipitation_amt_precipitation": "integer",
}

_LEADING = (*LOCATION, WEATHER_TIME, WEATHER_DATE, DATE_PARTITION)

# --- Raw documents --------------------------------------------------------------------------

_INT, _DOUBLE, _STRING = IntegerType(), DoubleType(), StringType()

_VARIANT = StructType([StructField("int", _INT), StructField("double", _DOUBLE)])


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, data_type) for name, data_type in fields.items()])


def raw_schema(variants: Collection[str] = ()) -> StructType:
    """Schema of a raw document. The numeric leaves named in ``variants`` (of ``current``,
    ``hourly`` and ``daily``) are declared as ``struct<int, double>`` instead of one number;
    a name that is none of them is an error."""
    known = set()

    def leaves(data_type: DataType, *names: str) -> dict[str, DataType]:
        known.update(names)
        return {name: _VARIANT if name in variants else data_type for name in names}

    weather = ArrayType(_struct(id=_INT, main=_STRING, description=_STRING, icon=_STRING))
    current = _struct(
        **leaves(_INT, "dt", "sunrise", "sunset"),
        **leaves(_DOUBLE, "temp", "feels_like"),
        **leaves(_INT, "pressure", "humidity"),
        **leaves(_DOUBLE, "dew_point", "uvi"),
        **leaves(_INT, "clouds", "visibility"),
        **leaves(_DOUBLE, "wind_speed"),
        **leaves(_INT, "wind_deg"),
        **leaves(_DOUBLE, "wind_gust"),
        weather=weather,
    )
    minutely = _struct(dt=_INT, precipitation=_DOUBLE)
    hourly = _struct(
        **leaves(_INT, "dt"),
        **leaves(_DOUBLE, "temp", "feels_like"),
        **leaves(_INT, "pressure", "humidity"),
        **leaves(_DOUBLE, "dew_point", "uvi"),
        **leaves(_INT, "clouds", "visibility"),
        **leaves(_DOUBLE, "wind_speed"),
        **leaves(_INT, "wind_deg"),
        **leaves(_DOUBLE, "wind_gust", "pop"),
        rain=_struct(**{"1h": _DOUBLE}),
        weather=weather,
    )
    daily = _struct(
        **leaves(_INT, "dt", "sunrise", "sunset", "moonrise", "moonset"),
        **leaves(_DOUBLE, "moon_phase"),
        temp=_struct(day=_DOUBLE, min=_DOUBLE, morn=_DOUBLE, eve=_DOUBLE, night=_DOUBLE),
        feels_like=_struct(day=_DOUBLE, night=_DOUBLE, morn=_DOUBLE, eve=_DOUBLE),
        **leaves(_INT, "pressure", "humidity"),
        **leaves(_DOUBLE, "dew_point"),
        **leaves(_INT, "wind_deg"),
        **leaves(_DOUBLE, "wind_gust"),
        **leaves(_INT, "clouds"),
        **leaves(_DOUBLE, "rain", "uvi", "pop"),
        weather=weather,
    )
    if unknown := set(variants) - known:
        raise ValueError(f"no numeric leaves of these names: {sorted(unknown)}")
    return _struct(
        lat=_DOUBLE,
        lon=_DOUBLE,
        timezone=_STRING,
        timezone_offset=_INT,
        current=current,
        minutely=ArrayType(minutely),
        hourly=ArrayType(hourly),
        daily=ArrayType(daily),
    )


RAW_SCHEMA = raw_schema()

def needed_schema(specs: Iterable[FeedSpec], schema: StructType = RAW_SCHEMA) -> StructType:
    """The part of a raw schema that some feeds read. JSON is parsed as far as the declared
    schema goes, and of the observation most feeds need only its time."""
    specs = tuple(specs)
    names = {name for spec in specs for name in spec.raw_columns}
    whole = any(spec.array is None for spec in specs)
    fields = []
    for column in schema:
        if column.name == OBSERVATION and not whole:
            time = StructType([column.dataType[OBSERVATION_DT]])
            fields.append(StructField(OBSERVATION, time))
        elif column.name in names:
            fields.append(column)
    return StructType(fields)


def needed_fields(specs: Iterable[FeedSpec]) -> dict[str, tuple[str, ...]]:
    """Structs of raw documents of which some feeds read certain fields alone."""
    return {OBSERVATION: (OBSERVATION_DT,)} if all(spec.array is not None for spec in specs) else {}


# --- Feeds ----------------------------------------------------------------------------------
# Prefixes, look-back, renames, drops and leading columns of the four feeds are fixed values.


@dataclass(frozen=True)
class FeedSpec:
    """What sets one feed apart; the two pipeline functions are the same for all."""

    name: str
    #: Array to explode to rows, or None if the feed is the observation itself.
    array: str | None
    #: Prefix of the feed's own columns in the clean layer.
    prefix: str
    #: Array of structs that the clean layer splits to columns, or None.
    weather: str | None
    #: Official types of the clean layer.
    clean_types: Mapping[str, DataType | str]
    #: Structs that get columns of their own; None for as many as the longest array of a batch
    #: has. A fixed width, which streams need, keeps the others in ``<weather>_more``.
    weather_width: int | None = None
    #: Seconds before the high-water mark that are read again for late data.
    lookback: int = 0
    #: Type that merged type variants get; ``float`` rounds to 32 bits.
    variant_type: str = "double"
    renames: Mapping[str, str] = field(default_factory=dict)
    drops: tuple[str, ...] = (CURRENT_DT,)
    #: Epoch columns that become timestamps in the analytic layer.
    epochs_to_times: Mapping[str, str] = field(default_factory=dict)
    #: Order of the analytic layer, and what happens to columns beyond it.
    leading: tuple[str, ...] = _LEADING
    rest: Literal["sorted", "drop"] = "sorted"
    #: Whether rows of one date are brought together before the analytic write.
    compact: bool = False

    @property
    def raw_columns(self) -> tuple[str, ...]:
        """Top-level raw columns the feed reads."""
        own = () if self.array is None else (self.array,)
        return (*LOCATION, OBSERVATION, *own)

    @property
    def grain(self) -> tuple[str, ...]:
        """Columns that identify a row of either layer: place, observation and forecast time."""
        own = () if self.array is None else (f"{self.prefix}_dt",)
        return ("lat", "lon", WEATHER_TIME, *own)

    @property
    def conditions(self) -> str | None:
        """Field of the raw documents that holds the weather conditions, or None."""
        return None if self.weather is None else self.weather.removeprefix(f"{self.prefix}_")


def _weather_names(array: str, state: str) -> dict[str, str]:
    return {f"{array}[0]_main": state, f"{array}[0]_description": f"{state}_desc"}


def _weather_drops(array: str) -> tuple[str, ...]:
    return (f"{array}[0]_id", f"{array}[0]_icon", CURRENT_DT)


CURRENT = FeedSpec(
    name="current",
    array=None,
    prefix="current",
    weather="current_weather",
    clean_types=CURRENT_TYPES,
    renames=_weather_names("current_weather", "current_weather_state"),
    drops=_weather_drops("current_weather"),
    epochs_to_times={
        "current_sunrise": "current_sunrise_time",
        "current_sunset": "current_sunset_time",
    },
    leading=(*_LEADING, "current_sunrise_time", "current_sunset_time"),
    compact=True,
)

DAILY = FeedSpec(
    name="daily",
    array="daily",
    prefix="daily_weather_forecast",
    weather="daily_weather_forecast_weather",
    clean_types=DAILY_TYPES,
    renames=_weather_names("daily_weather_forecast_weather", "daily_weather_state"),
    drops=_weather_drops("daily_weather_forecast_weather"),
    compact=True,
)

HOURLY = FeedSpec(
    name="hourly",
    array="hourly",
    prefix="hourly_weather_forecast",
    weather="hourly_weather_forecast_weather",
    clean_types=HOURLY_TYPES,
    lookback=3 * SECONDS_PER_DAY,
    renames=_weather_names("hourly_weather_forecast_weather", "hourly_weather_state"),
    drops=_weather_drops("hourly_weather_forecast_weather"),
)

MINUTELY = FeedSpec(
    name="minutely",
    array="minutely",
    prefix="time_precipitation_amt",
    weather=None,
    clean_types=MINUTELY_TYPES,
    leading=(*_LEADING, "time_precipitation_amt_dt", "time_precipitation_amt_precipitation"),
    rest="drop",
)

FEEDS = {spec.name: spec for spec in (CURRENT, DAILY, HOURLY, MINUTELY)}


def high_precision(spec: FeedSpec) -> FeedSpec:
    """The feed with doubles where the official types round to 32 bits or cut off fractions:
    every ``float``, and hourly feels-like and minutely precipitation."""
    fractions = {
        "hourly_weather_forecast_feels_like",
        "time_precipitation_amt_precipitation",
    }
    types = {
        name: "double" if data_type == "float" or name in fractions else data_type
        for name, data_type in spec.clean_types.items()
    }
    return replace(spec, clean_types=types)
