import glob
import os

import pyarrow.parquet
from pyspark.sql import functions as F

from tidemark import FEEDS, landed
from tidemark.plans.feeds import needed_fields
from tidemark.sources.documents import _SHREDDING
from tidemark.sources.staging import staging_root

CURRENT, DAILY, HOURLY = (FEEDS[name] for name in ("current", "daily", "hourly"))


def test_landed_documents_are_written_whole(spark):
    """Not taken apart by fields, which costs more than the parsing."""
    lines = spark.sql("""SELECT concat('{"a": ', id, ', "b": {"x": "', id, '"}}') AS value FROM range(100)""")
    before = spark.conf.get(_SHREDDING, None)
    with landed(lines) as batch:
        files = glob.glob(f"{staging_root(spark)}/tidemark/*/documents-*/*.parquet")
        assert files and not any("typed_value" in str(pyarrow.parquet.ParquetFile(file).schema) for file in files if os.path.getsize(file))
        assert batch.documents.agg(F.sum("a"), F.max("b.x")).first() == (4950, "99")
    assert spark.conf.get(_SHREDDING, None) == before


def test_objects_are_told_by_their_first_character(spark):
    texts = [' \t{"a": 1}', '{"a": 2} ', "[{}]", "null", '"{"', "{", '{"a": 1} x', " 7", "{}"]
    lines = spark.createDataFrame([(text,) for text in texts], "value string")
    kinds = lines.select("value", F.expr("coalesce(schema_of_variant(try_parse_json(value)) LIKE 'OBJECT%', false)").alias("object"))
    with landed(lines) as batch:
        assert batch.documents.count() == kinds.where("object").count() >= 3
        assert sorted(r["line"] for r in batch.malformed.collect()) == sorted(r["value"] for r in kinds.where("NOT object").collect())


def test_only_some_fields_of_a_struct(spark):
    lines = spark.createDataFrame([(t,) for t in ('{"current": {"dt": "5", "temp": 1}, "daily": [{"x": 1}]}', '{"current": 3}', '{"lat": 1}')], "value string")
    with landed(lines, only=needed_fields([DAILY, HOURLY])) as batch:
        assert batch.documents.schema.simpleString() == "struct<current:string,daily:array<struct<x:bigint>>,lat:bigint>"
    with landed(lines.limit(1), only=needed_fields([DAILY])) as batch:
        assert batch.documents.schema["current"].dataType.names == ["dt"] and batch.documents.first()["current"]["dt"] == "5"
        assert batch.found["current"].dataType.names == ["dt", "temp"]
    assert needed_fields([DAILY, CURRENT]) == {}
