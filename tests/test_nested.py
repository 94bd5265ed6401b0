import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark import flatten_all, flatten_struct, flatten_structs, struct_columns


def test_flatten_struct_replaces_in_place(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('x', 2, 'y', 'z') AS s, 3 AS b")
    flat = flatten_struct(df, "s")
    assert flat.columns == ["a", "s_x", "s_y", "b"]
    assert flat.collect() == [Row(a=1, s_x=2, s_y="z", b=3)]


def test_flatten_struct_opens_one_level_only(spark):
    df = spark.sql("SELECT named_struct('in', named_struct('x', 1)) AS s")
    assert flatten_struct(df, "s").schema["s_in"].dataType.simpleString() == "struct<x:int>"


def test_null_struct_gives_null_fields(spark):
    df = spark.sql("SELECT CAST(NULL AS STRUCT<x: INT, y: STRING>) AS s")
    assert flatten_struct(df, "s").collect() == [Row(s_x=None, s_y=None)]


@pytest.mark.parametrize("widths", [(2, 2, 2), (1, 1), (3, 3), (4, 6), (1, 3, 4, 6), (6, 1, 2)])
def test_flatten_structs_loses_nothing_whatever_the_widths(spark, widths):
    parts, expected, number = ["0 AS head"], {"head": 0}, 1
    for i, width in enumerate(widths):
        fields = []
        for j in range(width):
            fields.append(f"'f{j}', {number}")
            expected[f"s{i}_f{j}"] = number
            number += 1
        parts.append(f"named_struct({', '.join(fields)}) AS s{i}")
        parts.append(f"{-number} AS after{i}")
        expected[f"after{i}"] = -number
    df = spark.sql("SELECT " + ", ".join(parts))
    flat = flatten_structs(df, [f"s{i}" for i in range(len(widths))])
    assert flat.first().asDict() == expected
    assert flat.columns == list(expected)


def test_flatten_all_goes_to_any_depth_and_leaves_structs_with_arrays(spark):
    df = spark.sql(
        """SELECT named_struct('b', named_struct('c', named_struct('d', 1), 'e', 2)) AS a,
                  named_struct('list', array(1), 'n', 3) AS kept,
                  array(named_struct('x', 4)) AS many,
                  map('k', named_struct('y', 5)) AS lookup"""
    )
    flat = flatten_all(df)
    assert flat.columns == ["a_b_c_d", "a_b_e", "kept", "many", "lookup"]
    opened = flatten_all(df, into_arrays=True)
    assert opened.columns == ["a_b_c_d", "a_b_e", "kept_list", "kept_n", "many", "lookup"]


def test_flatten_all_without_structs_is_the_same_frame(spark):
    df = spark.range(1)
    assert flatten_all(df) is df


def test_struct_columns_tell_structs_with_arrays_apart(spark):
    schema = spark.sql(
        "SELECT 1 AS n, named_struct('x', 1) AS s, named_struct('array', 1) AS named_so, "
        "named_struct('l', named_struct('m', array(1))) AS t, array(named_struct('x', 1)) AS u"
    ).schema
    assert struct_columns(schema) == ["s", "named_so", "t"]
    assert struct_columns(schema, with_arrays=False) == ["s", "named_so"]


def test_names_that_collide_are_refused(spark):
    df = spark.sql("SELECT 1 AS a_b, named_struct('b', 2) AS a")
    with pytest.raises(ValueError, match="a_b"):
        flatten_struct(df, "a")
    with pytest.raises(ValueError):
        flatten_struct(spark.sql("SELECT 1 AS a_b, named_struct('B', 2) AS a"), "a")


def test_odd_names_and_other_separators(spark):
    df = spark.sql(
        "SELECT named_struct('1h', 1, 'a.b', 2, 'c`d', 3, 'e f', 4) AS `rain[0].x`"
    )
    flat = flatten_struct(df, "rain[0].x", sep=".")
    assert flat.columns == ["rain[0].x.1h", "rain[0].x.a.b", "rain[0].x.c`d", "rain[0].x.e f"]
    assert list(flat.first()) == [1, 2, 3, 4]


def test_names_are_matched_without_case(spark):
    df = spark.sql("SELECT named_struct('x', 1) AS Station")
    assert flatten_struct(df, "station").columns == ["Station_x"]


def test_wrong_columns_are_refused(spark):
    df = spark.sql("SELECT 1 AS a")
    with pytest.raises(TypeError):
        flatten_struct(df, "a")
    with pytest.raises(ValueError):
        flatten_struct(df, "absent")


def test_flattening_is_one_projection(spark, plan):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").selectExpr(
        "o_orderkey", "named_struct('b', named_struct('c', o_custkey, 'd', o_orderdate)) AS a"
    )
    text = plan(flatten_all(df).select("a_b_c"))
    assert "Exchange" not in text
    assert "ReadSchema: struct<o_custkey:bigint>" in text


_TREES = st.recursive(
    st.integers(0, 9),
    lambda inner: st.dictionaries(st.sampled_from("abcde"), inner, min_size=1, max_size=4),
    max_leaves=8,
)


def _schema_of(tree):
    if isinstance(tree, int):
        return IntegerType()
    return StructType([StructField(name, _schema_of(value)) for name, value in tree.items()])


def _leaves_of(tree, prefix):
    if isinstance(tree, int):
        return {prefix: tree}
    leaves = {}
    for name, value in tree.items():
        leaves |= _leaves_of(value, f"{prefix}_{name}")
    return leaves


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.sampled_from("vwxyz"), _TREES, min_size=1, max_size=4))
def test_flatten_all_keeps_every_leaf(spark, tree):
    df = spark.createDataFrame([tree], _schema_of(tree))
    expected = {}
    for name, value in tree.items():
        expected |= _leaves_of(value, name)
    assert flatten_all(df).first().asDict() == expected
