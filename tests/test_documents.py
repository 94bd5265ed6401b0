import glob
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidemark import FEEDS, RAW_SCHEMA, landed, merge_variants_within, parse_documents, read_layer
from tidemark.__main__ import main
from tidemark.sources.documents import schema_of
from tidemark.sources.files import read_text
from tidemark.sources.staging import staging_root
from weather import NOON, document, hour, write_json

SCHEMA = (StructType().add("dt", "integer").add("temp", "double").add("rain", StructType().add("1h", "double"))
          .add("weather", ArrayType(StructType().add("id", "integer"))))


def lines(spark, *documents):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in documents], "value string")


def test_numbers_are_read_however_they_are_spelled(spark):
    with landed(lines(spark, {"dt": 5}, {"dt": 5.0}, {"dt": "5"}, {"dt": "x"}, {"dt": None}, {"dt": 1e300}), SCHEMA) as batch:
        assert sorted((r["dt"] for r in batch.documents.collect()), key=repr) == [5, 5, 5, None, None, None]


def test_a_value_that_does_not_fit_spoils_no_other(spark):
    odd = {"dt": 1, "temp": "warm", "rain": {"1h": "much", "3h": 2}, "weather": [{"id": "x", "icon": "a"}, 7, None, {"id": 2}]}
    with landed(lines(spark, odd), SCHEMA) as batch:
        row = batch.documents.first().asDict(recursive=True)
    assert row["temp"] is None and row["rain"] == {"1h": None, "3h": 2} and row["dt"] == 1
    assert row["weather"] == [{"id": None}, None, None, {"id": 2}]  # elements of no one type: as declared


def test_fields_of_all_batches_stay(spark, tmp_path):
    store = str(tmp_path / "schemas" / "raw.json")
    with landed(lines(spark, {"a": 1, "b": {"x": 1}}), store=store) as batch:
        assert batch.documents.columns == ["a", "b"]
    with landed(lines(spark, {"a": 2.5, "b": {"y": "q"}, "c.d": [1]}), store=store) as batch:
        assert batch.documents.schema.simpleString() == "struct<a:double,b:struct<x:bigint,y:string>,c.d:array<bigint>>"
        assert batch.found.names == ["a", "b", "c.d"]
    with landed(lines(spark, {"a": "text"}), store=store) as batch:
        row = batch.documents.first()
        assert row["a"] == "text" and row["b"] is None and row["c.d"] is None
    assert json.loads(read_text(spark, store))["fields"][0]["type"] == "string"


def test_lines_are_parsed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    with landed(lines(spark, {"a": 1}, {"b": 2}).mapInArrow(count, "value string")) as batch:
        assert batch.documents.count() == 2 and batch.documents.agg(F.max("b")).first()[0] == 2
    assert seen.value == 2


def test_lines_that_are_no_documents_are_kept_apart(spark):
    with landed(lines(spark, {"a": 1}, "not json", "", "  ", "[1]", '"text"', "7", "null", '{"a": 1, "a": 2}')) as batch:
        assert [tuple(r) for r in batch.documents.collect()] == [(1,)]
        assert sorted(r["line"] for r in batch.malformed.collect()) == sorted(["not json", "[1]", '"text"', "7", "null", '{"a": 1, "a": 2}'])
    assert not glob.glob(f"{staging_root(spark)}/tidemark/*/documents-*")


def test_no_documents_have_the_declared_columns(spark):
    for some in (lines(spark, {"dt": 1}).limit(0), lines(spark, "x")):
        with landed(some, SCHEMA) as batch:
            assert batch.documents.columns == SCHEMA.names and batch.documents.count() == 0
    assert schema_of(None) == schema_of("VOID") == StructType([])


def test_fields_that_were_never_filled(spark):
    with landed(lines(spark, {"dt": None, "new": None, "empty": [], "none": {}})) as batch:
        assert batch.documents.schema["new"].dataType.simpleString() == "string"
        assert batch.documents.first()["empty"] == []


def test_names_that_differ_in_case_only_are_an_error(spark):
    with pytest.raises(ValueError, match="share one name"), landed(lines(spark, {"a": 1, "A": 2})):
        pass


def test_declared_reader_with_a_rest(spark):
    text = lines(spark, {"dt": "7", "temp": 1, "more": {"x": 1}}, "no json")
    rows = parse_documents(text, F.col("value"), SCHEMA, rest="document").select("dt", "temp", F.expr("variant_get(document, '$.more.x', 'int')")).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted([(7, 1.0, 1), (None, None, None)], key=repr)


def test_command_line_learns_the_schema(spark, tmp_path):
    raw, out, store = tmp_path / "raw", str(tmp_path / "clean"), str(tmp_path / "schema.json")
    for i, extra in enumerate(({"rain": {"1h": 0.5}}, {"snow": {"1h": 1}, "dt": float(NOON + 5)})):
        first = document(NOON + i, hourly=[hour(NOON)])
        first["current"] |= extra
        main(["clean", "--raw", write_json(raw / str(i), [first]), "--out", out, "--feed", "current", "--schema", store, "--overwrite", "touched"])
    rows = read_layer(spark, f"{out}/current").select("current_dt", "current_rain_1h", "current_snow_1h").collect()
    assert sorted(map(tuple, rows)) == [(NOON, 0.5, None), (NOON + 5, None, 1)]


def test_documents_have_all_documented_columns(spark):
    with landed(lines(spark, document(NOON)), RAW_SCHEMA) as batch:
        assert set(RAW_SCHEMA.names) <= set(batch.documents.columns)
        assert batch.documents.select("hourly").first()[0] is None and FEEDS["daily"].array in batch.documents.columns


def test_variants_within_structs_arrays_and_maps(spark):
    df = spark.sql("""
        SELECT named_struct('day', named_struct('int', 1, 'double', CAST(NULL AS DOUBLE)), 'unit', 'K') AS temp,
               array(named_struct('id', named_struct('int', 2), 'xs', array(named_struct('double', 0.5D, 'int', 3), NULL)), NULL) AS list,
               map('a', named_struct('int', 4, 'double', 4.5D)) AS m, named_struct('int', 5, 'text', 'x') AS other, 1 AS plain""")
    merged = merge_variants_within(df)
    assert merged.schema.simpleString() == ("struct<temp:struct<day:double,unit:string>,list:array<struct<id:double,xs:array<double>>>,"
                                            "m:map<string,double>,other:struct<int:int,text:string>,plain:int>")
    row = merged.first().asDict(recursive=True)
    assert row["temp"] == {"day": 1.0, "unit": "K"} and row["m"] == {"a": 4.5}
    assert row["list"] == [{"id": 2.0, "xs": [0.5, None]}, None]
    assert merge_variants_within(df, ["plain"]) is df
