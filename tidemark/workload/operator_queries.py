"""Each operator by itself, over the test tables.

Nested columns are packed, and arrays built, within the row they come from, so no query
gathers rows of a key and none depends on how rows are spread over keys."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import add_time_columns
from tidemark.operators.arrays import explode_prefix, first_struct, split_to_columns
from tidemark.operators.incremental import (
    EPOCH_ZERO,
    high_water_mark,
    newer_than,
    newer_than_per_key,
    read_mark,
    run_if_any,
)
from tidemark.operators.nested import flatten_all, flatten_struct, flatten_structs
from tidemark.operators.reconcile import merge_variants
from tidemark.operators.shaping import enforce, rename_drop, reorder
from tidemark.plans.feeds import SECONDS_PER_DAY
from tidemark.sources.layers import read_layer
from tidemark.sources.readers import read_table
from tidemark.sources.staging import staging_path
from tidemark.sources.writers import compact, write_partitioned
from tidemark.workload.inputs import CUTOFF, EVENTS_CTE, events, table
from tidemark.workload.registry import Registry, without_zone

registry = Registry()

# --- Structs --------------------------------------------------------------------------------


@registry.add(
    "flatten_struct",
    """
    SELECT o_orderkey, o_custkey AS order_customer, o_orderstatus AS order_status,
           o_totalprice AS order_total, o_orderdate AS order_date, o_orderpriority
    FROM orders
    """,
)
def _flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        """named_struct('customer', o_custkey, 'status', o_orderstatus,
                        'total', o_totalprice, 'date', o_orderdate) AS order""",
        "o_orderpriority",
    )
    return flatten_struct(packed, "order")


@registry.add(
    "flatten_structs_widths",
    """
    SELECT l_orderkey AS key_order, l_partkey, l_quantity AS amounts_quantity,
           l_extendedprice AS amounts_price, l_discount AS amounts_discount, l_suppkey,
           l_tax AS rest_tax, l_returnflag AS rest_returned, l_linestatus AS rest_status,
           l_shipdate AS rest_shipped, l_linenumber
    FROM lineitem
    """,
)
def _flatten_structs_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = table(spark, sf_dir, "lineitem").selectExpr(
        "named_struct('order', l_orderkey) AS key",
        "l_partkey",
        """named_struct('quantity', l_quantity, 'price', l_extendedprice,
                        'discount', l_discount) AS amounts""",
        "l_suppkey",
        """named_struct('tax', l_tax, 'returned', l_returnflag, 'status', l_linestatus,
                        'shipped', l_shipdate) AS rest""",
        "l_linenumber",
    )
    return flatten_structs(packed, ["key", "amounts", "rest"])


@registry.add(
    "flatten_all_nested",
    """
    SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal AS customer_balance,
           n_name AS customer_nation_name, r_regionkey AS customer_nation_region_key,
           r_name AS customer_nation_region_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey
    """,
)
def _flatten_all_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            """named_struct('key', c_custkey, 'name', c_name, 'balance', c_acctbal,
                'nation', named_struct('name', n_name,
                    'region', named_struct('key', r_regionkey, 'name', r_name))) AS customer"""
        )
    )
    return flatten_all(nested)


@registry.add(
    "json_document",
    """
    SELECT event_id, CAST(props->>'k' AS INTEGER) AS props_k
    FROM events
    """,
)
def _json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k INT").alias("props")
    )
    return flatten_all(parsed)


# --- Arrays ---------------------------------------------------------------------------------

#: Up to three charges of a line, none where the amount is 0.
_CHARGES = """filter(
    array(named_struct('kind', 'discount', 'amount', l_discount),
          named_struct('kind', 'tax', 'amount', l_tax),
          named_struct('kind', 'excess', 'amount', greatest(l_quantity - 25, 0))),
    charge -> charge.amount > 0) AS charge"""

_CHARGES_SQL = """list_filter(
    [{kind: 'discount', amount: l_discount}, {kind: 'tax', amount: l_tax},
     {kind: 'excess', amount: greatest(l_quantity - 25, 0)}],
    lambda charge: charge.amount > 0)"""

_LINE = ("l_orderkey", "l_partkey", "l_linenumber")


def _charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_LINE, _CHARGES)


@registry.add(
    "explode_children",
    f"""
    SELECT {", ".join(_LINE)}, c.kind AS charge_kind, c.amount AS charge_amount
    FROM (SELECT *, unnest({_CHARGES_SQL}) AS c FROM lineitem)
    """,
)
def _explode_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_prefix(_charges(spark, sf_dir), "charge", "charge")


@registry.add(
    "explode_children_outer",
    f"""
    WITH lines AS (SELECT *, {_CHARGES_SQL} AS charges FROM lineitem)
    SELECT {", ".join(_LINE)}, CAST(i - 1 AS INTEGER) AS charge_pos,
           charges[i].kind AS charge_kind, charges[i].amount AS charge_amount
    FROM (SELECT *, unnest(range(1, len(charges) + 1)) AS i FROM lines WHERE len(charges) > 0)
    UNION ALL
    SELECT {", ".join(_LINE)}, NULL, NULL, NULL FROM lines WHERE len(charges) = 0
    """,
)
def _explode_children_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_prefix(
        _charges(spark, sf_dir), "charge", "charge", outer=True, with_pos=True
    )


@registry.add(
    "explode_lines",
    """
    WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
    SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_pos, lines[i] AS line
    FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM split)
    """,
)
def _explode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = table(spark, sf_dir, "documents").selectExpr("doc_id", "split(text, '\\n') AS lines")
    return explode_prefix(split, "lines", "line", with_pos=True)


@registry.add(
    "split_array",
    "SELECT vec_id, "
    + ", ".join(f'embedding[{i + 1}] AS "embedding[{i}]"' for i in range(64))
    + " FROM embeddings",
)
def _split_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return split_to_columns(vectors, "embedding", width=64)


@registry.add(
    "split_ragged",
    f"""
    WITH lines AS (SELECT *, {_CHARGES_SQL} AS charges FROM lineitem)
    SELECT {", ".join(_LINE)},
           {", ".join(f'charges[{i + 1}].amount AS "amounts[{i}]"' for i in range(3))}
    FROM lines
    """,
)
def _split_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = _charges(spark, sf_dir).selectExpr(*_LINE, "charge.amount AS amounts")
    return split_to_columns(amounts, "amounts")


@registry.add(
    "first_struct",
    f"""
    WITH lines AS (SELECT *, {_CHARGES_SQL} AS charges FROM lineitem)
    SELECT {", ".join(_LINE)}, charges[1].kind AS "charge[0]_kind",
           charges[1].amount AS "charge[0]_amount"
    FROM lines
    """,
)
def _first_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_struct(_charges(spark, sf_dir), "charge")


# --- Type variants --------------------------------------------------------------------------

_VARIANTS = (
    "event_id",
    "CAST(IF(value = floor(value), value, NULL) AS INT) AS reading_int",
    "IF(value = floor(value), NULL, value) AS reading_double",
    "IF(event_id % 3 = 0, CAST(event_id AS INT), NULL) AS reading_rank_int",
    "event_type AS reading_interval",
)


@registry.add(
    "merge_variants",
    """
    SELECT event_id, event_type AS reading_interval, value AS reading,
           CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS DOUBLE) END AS reading_rank
    FROM events
    """,
)
def _merge_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_variants(table(spark, sf_dir, "events").selectExpr(*_VARIANTS))


@registry.add(
    "merge_variants_float",
    """
    SELECT event_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS reading
    FROM events
    """,
)
def _merge_variants_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = table(spark, sf_dir, "events").selectExpr(*_VARIANTS[:3])
    merged = merge_variants(variants, target_type="float")
    return enforce(merged, {"reading": "double"})


# --- Times, types, names, order -------------------------------------------------------------


@registry.add(
    "time_columns",
    """
    SELECT event_id, CAST(floor(epoch(ts)) AS INTEGER) AS s,
           date_trunc('second', ts) AS seen_time, CAST(ts AS DATE) AS seen_date,
           CAST(ts AS DATE) AS seen_date_partition
    FROM events
    """,
)
def _time_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_zone(
        add_time_columns(events(spark, sf_dir).select("event_id", "s"), "s", "seen")
    )


@registry.add(
    "enforce_schema",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_partkey, l_linenumber,
           CAST(l_quantity AS INTEGER) AS l_quantity,
           TRY_CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice,
           TRY_CAST(trunc(l_extendedprice * 100000) AS INTEGER) AS l_scaled,
           CAST(l_discount AS FLOAT) AS l_discount,
           TRY_CAST(l_linestatus AS INTEGER) AS l_linestatus
    FROM lineitem
    """,
)
def _enforce_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        *_LINE,
        "l_quantity",
        "l_extendedprice",
        "l_extendedprice * 100000 AS l_scaled",
        "l_discount",
        "l_linestatus",
    )
    types = {
        "l_orderkey": "string",
        "l_quantity": "integer",
        "l_extendedprice": "integer",
        "l_scaled": "integer",
        "l_discount": "float",
        "l_linestatus": "integer",
        "l_absent": "double",
    }
    return enforce(lines, types)


@registry.add(
    "rename_drop_reorder",
    """
    SELECT s_name AS supplier, s_suppkey, s_acctbal
    FROM supplier
    """,
)
def _rename_drop_reorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    renames = {"s_name": "supplier", "s_absent": "absent"}
    shaped = rename_drop(
        table(spark, sf_dir, "supplier"), renames, ["s_nationkey", "s_missing"]
    )
    return reorder(shaped, ["supplier", "s_suppkey"])


# --- Increments -----------------------------------------------------------------------------

_BEFORE_SQL = f"ts < TIMESTAMP '{CUTOFF}'"
_MARK_SQL = f"(SELECT max(s) FROM e WHERE {_BEFORE_SQL})"


def _processed(rows: DataFrame) -> DataFrame:
    """The events that count as processed."""
    return rows.where(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))


def _seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", "user_id", "ts", "s")


@registry.add(
    "hwm_epoch", f"WITH {EVENTS_CTE} SELECT max(s) AS high_water_mark FROM e"
)
def _hwm_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(_seconds(spark, sf_dir), "s", EPOCH_ZERO)


@registry.add(
    "hwm_empty_default",
    f"""
    WITH {EVENTS_CTE}
    SELECT coalesce(max(s), 0) AS high_water_mark FROM e WHERE value < -1
    """,
)
def _hwm_empty_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(events(spark, sf_dir).where("value < -1"), "s", EPOCH_ZERO)


@registry.add(
    "hwm_timestamp",
    """
    SELECT coalesce(max(o_orderdate), TIMESTAMP '1970-01-01 00:00:00') AS high_water_mark
    FROM orders
    """,
)
def _hwm_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(table(spark, sf_dir, "orders"), "o_orderdate", datetime(1970, 1, 1))


@registry.add(
    "hwm_by_partition", f"WITH {EVENTS_CTE} SELECT max(s) AS high_water_mark FROM e"
)
def _hwm_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "hwm-by-partition")
    rows = add_time_columns(_seconds(spark, sf_dir).select("s"), "s", "seen")
    write_partitioned(compact(rows, "seen_date_partition"), path, "seen_date_partition")
    layer = read_layer(spark, path)
    return high_water_mark(layer, "s", EPOCH_ZERO, partition="seen_date_partition")


@registry.add(
    "increment_strict",
    f"WITH {EVENTS_CTE} SELECT event_id, user_id, ts, s FROM e WHERE s > {_MARK_SQL}",
)
def _increment_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _seconds(spark, sf_dir)
    return newer_than(rows, "s", high_water_mark(_processed(rows), "s"))


@registry.add(
    "increment_lookback",
    f"""
    WITH {EVENTS_CTE}
    SELECT event_id, user_id, ts, s FROM e WHERE s > {_MARK_SQL} - 3 * 86400
    """,
)
def _increment_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _seconds(spark, sf_dir)
    mark = read_mark(high_water_mark(_processed(rows), "s"))
    return newer_than(rows, "s", mark, lookback=3 * SECONDS_PER_DAY)


@registry.add(
    "increment_timestamp",
    f"""
    SELECT event_id, ts, value
    FROM events WHERE ts > (SELECT max(ts) FROM events WHERE {_BEFORE_SQL})
    """,
)
def _increment_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    mark = read_mark(high_water_mark(_processed(rows), "ts", datetime(1970, 1, 1)))
    return newer_than(rows, "ts", mark)


@registry.add(
    "increment_per_key",
    f"""
    WITH {EVENTS_CTE},
    marks AS (SELECT user_id, max(s) AS mark FROM e WHERE {_BEFORE_SQL} GROUP BY user_id)
    SELECT event_id, user_id, ts, s
    FROM e LEFT JOIN marks USING (user_id) WHERE s > coalesce(mark, 0)
    """,
)
def _increment_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _seconds(spark, sf_dir)
    return newer_than_per_key(rows, "s", _processed(rows), ["user_id"])


@registry.add(
    "non_empty_gate",
    f"""
    WITH {EVENTS_CTE}
    SELECT event_id, s, 'kept' AS outcome FROM e WHERE {_BEFORE_SQL}
    UNION ALL
    SELECT event_id, s, 'written' AS outcome FROM e WHERE s > {_MARK_SQL}
    """,
)
def _non_empty_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing is newer than the newest of all events, so for that mark the earlier output is
    kept; beyond the processed ones there are rows, so the action runs."""
    rows = _seconds(spark, sf_dir).select("event_id", "s", "ts")

    def written(increment: DataFrame) -> DataFrame:
        return increment.select("event_id", "s", F.lit("written").alias("outcome"))

    kept = _processed(rows).select("event_id", "s", F.lit("kept").alias("outcome"))
    nothing = run_if_any(newer_than(rows, "s", read_mark(high_water_mark(rows, "s"))), written)
    some = run_if_any(
        newer_than(rows, "s", read_mark(high_water_mark(_processed(rows), "s"))), written
    )
    return (kept if nothing is None else nothing).unionAll(kept if some is None else some)


# --- Catalog, join, storage -----------------------------------------------------------------


@registry.add(
    "catalog_view_query",
    """
    SELECT o_orderkey, o_orderdate, o_totalprice
    FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders
                                     WHERE o_orderdate < TIMESTAMP '1998-01-01')
    """,
)
def _catalog_view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("tidemark_orders")
    orders = read_table(spark, "tidemark_orders")
    return spark.sql(
        """
        SELECT o_orderkey, o_orderdate, o_totalprice
        FROM {orders} WHERE o_orderdate > (
            SELECT CASE WHEN max(o_orderdate) IS NULL THEN TIMESTAMP_NTZ '1970-01-01'
                        ELSE max(o_orderdate) END
            FROM tidemark_orders WHERE o_orderdate < CAST(:before AS TIMESTAMP_NTZ))
        """,
        args={"before": "1998-01-01"},
        orders=orders,
    )


@registry.add(
    "join_inner",
    """
    SELECT o_orderkey, o_orderdate, l_linenumber, l_extendedprice
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    """,
)
def _join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner").drop(
        "l_orderkey"
    )


@registry.add(
    "partition_roundtrip",
    "SELECT *, CAST(ts AS DATE) AS day FROM events",
)
def _partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "partition-roundtrip")
    rows = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    write_partitioned(compact(rows, "day"), path, "day")
    return read_layer(spark, path)


@registry.add(
    "partition_touched",
    f"""
    SELECT event_id, CASE WHEN CAST(ts AS DATE) >= CAST('{CUTOFF[:10]}' AS DATE)
                          THEN -value ELSE value END AS value, CAST(ts AS DATE) AS day
    FROM events
    """,
)
def _partition_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "partition-touched")
    rows = table(spark, sf_dir, "events").select(
        "event_id", "value", F.to_date("ts").alias("day")
    )
    write_partitioned(compact(rows, "day"), path, "day")
    corrected = rows.where(F.col("day") >= F.lit(CUTOFF[:10]).cast("date")).withColumn(
        "value", -F.col("value")
    )
    write_partitioned(compact(corrected, "day"), path, "day", overwrite="touched")
    return read_layer(spark, path)
