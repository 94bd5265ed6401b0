"""Reading raw documents and catalog tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_raw(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    """JSON-lines files of a directory. With a schema they are parsed once, and only in the
    fields a query uses; ``None`` infers it, at the price of one more pass over all files,
    and so keeps fields the schema does not name. Malformed lines give NULL fields."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def parse_raw(df: DataFrame, text: Column, schema: StructType) -> DataFrame:
    """Documents held as JSON text in a column, e.g. of a table the raw files landed in.

    The fields come out of a generator, which parses each text once. Were they taken from a
    parsed column, the optimizer would parse anew for filters on them. It cannot leave out
    fields by itself here, so pass a schema of those that are needed."""
    document = F.array(F.from_json(text, schema))
    return df.select(F.inline(document))


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """Catalog table or view. The name is qualified rather than the session's current
    database changed, so that reads of several layers cannot disturb each other."""
    parts = [name] if database is None else [database, name]
    return spark.table(".".join(f"`{part}`" for part in parts))
