import pytest
from pyspark.sql import Row

from tidemark import explode_prefix, first_struct, max_length, split_to_columns

ARRAYS = """SELECT * FROM VALUES
    (1, array(named_struct('dt', 10, 'v', 'a'), named_struct('dt', 11, 'v', 'b'))),
    (2, array()),
    (3, NULL),
    (4, array(named_struct('dt', 40, 'v', NULL))),
    (5, array(CAST(NULL AS STRUCT<dt: INT, v: STRING>))) AS t(id, xs)"""


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_explode_drops_rows_without_elements_but_keeps_null_elements(spark):
    exploded = explode_prefix(spark.sql(ARRAYS), "xs", "x")
    assert exploded.columns == ["id", "x_dt", "x_v"]
    assert rows(exploded) == sorted(
        [(1, 10, "a"), (1, 11, "b"), (4, 40, None), (5, None, None)], key=str
    )


def test_explode_outer_with_position(spark):
    exploded = explode_prefix(spark.sql(ARRAYS), "xs", "x", outer=True, with_pos=True)
    assert exploded.columns == ["id", "x_pos", "x_dt", "x_v"]
    assert rows(exploded) == sorted(
        [(1, 0, 10, "a"), (1, 1, 11, "b"), (2, None, None, None), (3, None, None, None),
         (4, 0, 40, None), (5, 0, None, None)],
        key=str,
    )


def test_explode_plain_elements(spark):
    df = spark.sql("SELECT array(3, 4) AS xs, 1 AS id")
    assert rows(explode_prefix(df, "xs", "x")) == [(1, 3), (1, 4)]


def test_explode_beside_columns_named_like_the_generator(spark):
    df = spark.sql("SELECT 1 AS col, 2 AS pos, 3 AS dt, array(named_struct('dt', 4)) AS xs")
    assert explode_prefix(df, "xs", "xs").collect() == [Row(col=1, pos=2, dt=3, xs_dt=4)]


def test_explode_refuses_collisions_and_other_types(spark):
    df = spark.sql("SELECT 1 AS x_dt, array(named_struct('dt', 4)) AS xs, 5 AS n")
    with pytest.raises(ValueError):
        explode_prefix(df, "xs", "x")
    with pytest.raises(TypeError):
        explode_prefix(df, "n", "m")


def test_explode_neither_shuffles_nor_computes_the_array_twice(spark, plan):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
        "event_id", "from_json(props, 'k INT, xs ARRAY<STRUCT<a: INT>>').xs AS xs"
    )
    text = plan(explode_prefix(df, "xs", "x"), "extended")
    physical = text[text.index("== Physical Plan =="):]
    assert "Exchange" not in physical
    assert physical.count("from_json") == 1


def test_explode_count_is_the_sum_of_sizes(spark):
    df = spark.sql("SELECT id, IF(id % 5 = 0, NULL, sequence(1, id % 7)) AS xs FROM range(200)")
    df = df.selectExpr("id", "IF(id % 7 = 0, array(), xs) AS xs")
    total = df.selectExpr("sum(coalesce(greatest(size(xs), 0), 0))").first()[0]
    assert explode_prefix(df, "xs", "x").count() == total


def test_split_pads_and_cuts(spark):
    df = spark.sql("SELECT * FROM VALUES (1, array(7, 8)), (2, array(9)), (3, NULL) AS t(id, xs)")
    assert split_to_columns(df, "xs", width=3).columns == ["id", "xs[0]", "xs[1]", "xs[2]"]
    assert rows(split_to_columns(df, "xs", width=3)) == [
        (1, 7, 8, None), (2, 9, None, None), (3, None, None, None)
    ]
    assert rows(split_to_columns(df, "xs", width=1)) == [(1, 7), (2, 9), (3, None)]


def test_split_finds_the_width_of_the_batch(spark):
    df = spark.sql("SELECT * FROM VALUES (1, array(7, 8, 9)), (2, array(9)) AS t(id, xs)")
    assert max_length(df, "xs") == 3
    assert split_to_columns(df, "xs").columns == ["id", "xs[0]", "xs[1]", "xs[2]"]
    empty = df.where("id > 5")
    assert max_length(empty, "xs") == 0
    assert split_to_columns(empty, "xs").columns == ["id"]
    nulls = spark.sql("SELECT CAST(NULL AS ARRAY<INT>) AS xs")
    assert max_length(nulls, "xs") == 0


def test_split_then_gather_gives_the_padded_array(spark):
    df = spark.sql("SELECT id, sequence(id, id + id % 4) AS xs FROM range(50)")
    split = split_to_columns(df, "xs")
    for row in split.collect():
        values = list(row)[1:]
        wanted = list(range(row["id"], row["id"] + row["id"] % 4 + 1))
        assert values == wanted + [None] * (4 - len(wanted))


def test_split_is_a_projection(spark, plan):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    text = plan(split_to_columns(df, "embedding", width=8))
    assert "Exchange" not in text and "Join" not in text


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_split_does_not_depend_on_ansi_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.sql("SELECT * FROM VALUES (array(1)), (NULL) AS t(xs)")
        assert max_length(df, "xs") == 1
        assert rows(split_to_columns(df, "xs", width=2)) == [(1, None), (None, None)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_first_struct_of_arrays_of_length_0_1_2_and_null(spark):
    first = first_struct(spark.sql(ARRAYS), "xs")
    assert first.columns == ["id", "xs[0]_dt", "xs[0]_v"]
    assert rows(first) == sorted(
        [(1, 10, "a"), (2, None, None), (3, None, None), (4, 40, None), (5, None, None)],
        key=str,
    )


def test_first_struct_exists_when_all_arrays_are_empty(spark):
    first = first_struct(spark.sql(ARRAYS).where("id = 2"), "xs")
    assert dict(first.dtypes) == {"id": "int", "xs[0]_dt": "int", "xs[0]_v": "string"}


def test_more_than_the_first_struct_is_flattened_alike(spark):
    two = first_struct(spark.sql(ARRAYS), "xs", width=2)
    assert two.columns == ["id", "xs[0]_dt", "xs[0]_v", "xs[1]_dt", "xs[1]_v"]


def test_split_columns_can_be_named(spark):
    df = spark.sql(ARRAYS)
    first = first_struct(df, "xs", namer=lambda array, i: f"{array}_{i}")
    assert first.columns == ["id", "xs_0_dt", "xs_0_v"]


def test_first_struct_needs_structs(spark):
    with pytest.raises(TypeError):
        first_struct(spark.sql("SELECT array(1) AS xs"), "xs")
