import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import IntegerType

from tidemark import enforce, rename_drop, reorder


def test_enforce_casts_what_is_listed_and_leaves_the_rest(spark):
    df = spark.sql("SELECT '5' AS a, 2.9D AS b, -2.9D AS c, 'text' AS extra")
    cast = enforce(df, {"a": IntegerType(), "b": "integer", "c": "integer", "absent": "double"})
    assert cast.columns == ["a", "b", "c", "extra"]
    assert tuple(cast.first()) == (5, 2, -2, "text")


def test_values_that_do_not_fit_become_null(spark):
    df = spark.sql("SELECT 1e12D AS a, 'no number' AS b, 5000000000L AS c, 'NaN' AS d")
    cast = enforce(df, {"a": "integer", "b": "integer", "c": "integer", "d": "double"})
    row = cast.first()
    assert tuple(row)[:3] == (None, None, None)
    assert row["d"] != row["d"]


@pytest.mark.parametrize("source", ["double", "float", "bigint", "decimal(38,3)"])
def test_bounds_of_small_integers_are_exact(spark, source):
    df = spark.sql(
        f"""SELECT CAST(x AS {source}) AS x FROM VALUES
            (-129.0), (-128.9), (-128.0), (-0.9), (0.0), (127.0), (127.9), (128.0), (NULL)
            AS t(x)"""
    )
    got = [row[0] for row in enforce(df, {"x": "byte"}).collect()]
    wanted = [row[0] for row in df.selectExpr("try_cast(x AS TINYINT)").collect()]
    assert got == wanted and None in got and 127 in got and -128 in got


def test_text_is_read_as_a_number_without_its_fraction(spark):
    texts = {"12": 12, " -7 ": -7, "\t+3\n": 3, "12.7": 12, "-0.9": 0, "5.": 5, "": None,
             "1e3": None, "O": None, "1 2": None, ".": None, "-": None, "99999999999": None,
             "12abc": None, "١": None}
    df = spark.createDataFrame([(text,) for text in texts], "x STRING")
    got = {row.t: row.x for row in enforce(df.selectExpr("x AS t", "x"), {"x": "int"}).collect()}
    assert got == texts


def test_numbers_that_do_not_fit_are_found_without_raising(spark, plan):
    df = spark.sql("SELECT id * 1e9D AS x FROM range(10)")
    assert "try_cast" not in plan(enforce(df, {"x": "integer"}))


def test_strict_mode_fails_on_them(spark):
    df = spark.sql("SELECT 'no number' AS b")
    with pytest.raises(PySparkException):
        enforce(df, {"b": "integer"}, mode="cast").collect()
    with pytest.raises(ValueError):
        enforce(df, {"b": "integer"}, mode="guess")


def test_enforce_is_idempotent(spark):
    df = spark.sql("SELECT CAST(id AS STRING) AS a, id / 3 AS b FROM range(20)")
    types = {"a": "integer", "b": "float"}
    once = enforce(df, types)
    twice = enforce(once, types)
    assert once.schema == twice.schema
    assert once.collect() == twice.collect()


def test_enforce_is_one_projection_however_many_columns(spark, plan):
    df = spark.range(5).selectExpr(*(f"id AS c{i}" for i in range(150)))
    cast = enforce(df, {f"c{i}": "integer" for i in range(150)})
    assert plan(cast, "simple").count("Project") == 1


def test_enforce_keeps_bracketed_names(spark):
    df = spark.sql("SELECT '7' AS `weather[0]_id`")
    assert enforce(df, {"weather[0]_id": "integer"}).first().asDict() == {"weather[0]_id": 7}


def test_rename_then_drop_ignores_absent_names(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS `b[0]_main`, 3 AS c")
    shaped = rename_drop(df, {"b[0]_main": "state", "absent": "x"}, ["c", "missing"])
    assert shaped.columns == ["a", "state"]


def test_rename_refuses_a_name_that_is_taken(spark):
    with pytest.raises(ValueError):
        rename_drop(spark.sql("SELECT 1 AS a, 2 AS b"), {"a": "b"})


def test_reorder_sorts_the_rest_by_code_point(spark):
    df = spark.sql("SELECT 1 AS z, 2 AS a, 3 AS `b[0]`, 4 AS B1, 5 AS lead2, 6 AS lead1")
    assert reorder(df, ["lead1", "lead2"]).columns == ["lead1", "lead2", "B1", "a", "b[0]", "z"]
    assert reorder(df, ["lead1", "z"], rest="drop").columns == ["lead1", "z"]


def test_reorder_needs_its_leading_columns(spark):
    with pytest.raises(ValueError, match="absent"):
        reorder(spark.range(1), ["absent"])
