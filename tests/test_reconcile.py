import pytest

from tidemark import merge_variants, variant_groups


def test_groups_by_whole_suffix_in_order_of_first_sight():
    names = ["b_int", "id", "x_interval", "rain_int", "rain_1h_int", "rain_double", "b_double",
             "a_double", "_int", "print", "rain_1h_double"]
    assert variant_groups(names) == {
        "b": ["b_double", "b_int"],
        "rain": ["rain_double", "rain_int"],
        "rain_1h": ["rain_1h_double", "rain_1h_int"],
        "a": ["a_double"],
    }


def test_groups_with_other_suffixes():
    assert variant_groups(["x_long", "x_text"], ("_text", "_long")) == {"x": ["x_text", "x_long"]}


def test_merge_takes_the_first_that_is_there_and_prefers_the_double(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1, 5, 2.5D, 'a'), (2, 6, NULL, 'b'), (3, NULL, 3.5D, 'c'),
                                (4, NULL, NULL, 'd') AS t(id, x_int, x_double, x_interval)"""
    )
    merged = merge_variants(df)
    assert merged.columns == ["id", "x_interval", "x"]
    assert dict(merged.dtypes)["x"] == "double"
    assert [tuple(r) for r in merged.orderBy("id").collect()] == [
        (1, "a", 2.5), (2, "b", 6.0), (3, "c", 3.5), (4, "d", None)
    ]


def test_one_variant_alone_is_merged_too(spark):
    merged = merge_variants(spark.sql("SELECT 1 AS x_int, 2.5D AS y_double, 3 AS z"))
    assert merged.columns == ["z", "x", "y"]
    assert tuple(merged.first()) == (3, 1.0, 2.5)


def test_float_target_rounds_to_32_bits(spark):
    df = spark.sql("SELECT 281.66D AS x_double, CAST(NULL AS INT) AS x_int")
    assert merge_variants(df).first()[0] == 281.66
    rounded = merge_variants(df, target_type="float").selectExpr("CAST(x AS DOUBLE)").first()[0]
    assert rounded == 281.6600036621094


def test_merge_without_variants_is_the_same_frame(spark):
    df = spark.range(1)
    assert merge_variants(df) is df


def test_merge_refuses_a_base_that_is_a_column_already(spark):
    with pytest.raises(ValueError):
        merge_variants(spark.sql("SELECT 1 AS x, 2 AS x_int"))


def test_groups_can_be_given(spark):
    df = spark.sql("SELECT 1 AS x_int, 2 AS keep_int")
    merged = merge_variants(df, {"x": ["x_int"]})
    assert merged.columns == ["keep_int", "x"]


def test_merge_is_one_projection(spark, plan):
    df = spark.sql("SELECT id AS a_int, CAST(id AS DOUBLE) AS a_double, id AS b_int FROM range(9)")
    assert plan(merge_variants(df), "simple").count("Project") == 1
