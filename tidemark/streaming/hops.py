"""The two hops over streams of files.

The stream's checkpoint takes the place of the high-water mark: each raw file is read once,
however late its observations are, so no look-back is needed and no state is kept. The column
work is that of the batch pipelines."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.naming import column
from tidemark.plans.feeds import DATE_PARTITION, OBSERVATION, OBSERVATION_DT, FeedSpec
from tidemark.plans.pipelines import analytic_rows, clean_rows
from tidemark.sources.layers import Layer


def read_raw_stream(spark: SparkSession, path: str, schema: StructType,
                    files_per_batch: int | None = None) -> DataFrame:
    """JSON-lines files as they arrive in a directory. Streams need the schema declared."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def read_layer_stream(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet files as they are added to a layer, with the columns its batches have had so far,
    or those of ``schema``."""
    if schema is None:
        state = Layer(spark, path, DATE_PARTITION).state()
        if state is None:
            raise ValueError(f"{path!r} has no stored schema; pass one")
        schema = state.schema
    return spark.readStream.schema(schema).parquet(path)


def clean_stream(spec: FeedSpec, raw: DataFrame) -> DataFrame:
    """Clean rows of a raw stream. Documents without an observation time are left out. As a
    stream has one schema, a feed without a fixed width has columns for one weather condition,
    and the others in an array."""
    if spec.weather_width is None:
        spec = replace(spec, weather_width=1)
    return clean_rows(spec, raw.where(column(OBSERVATION, OBSERVATION_DT).isNotNull()))


def analytic_stream(spec: FeedSpec, clean: DataFrame) -> DataFrame:
    """Analytic rows of a stream of clean rows."""
    return analytic_rows(spec, clean)


def start_layer(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is available now to a layer, one directory per date, then stop. The next
    start with the same ``checkpoint`` goes on from there. The layer's stored schema takes in
    the stream's first, so a stream of other columns than the last one loses none."""
    Layer(rows.sparkSession, path, DATE_PARTITION).register(rows.schema)
    return (
        rows.writeStream.format("parquet")
        .partitionBy(DATE_PARTITION)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
