"""Measure the library's choices against the plain alternatives; prints one JSON line.

Runs on documents derived from ``$BENCH_SF_DIR``, written once to the shared folder as eight
Parquet files and as JSON."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bench import produce, seconds, session
from tidemark.functions.naming import column
from tidemark.operators.arrays import split_to_columns
from tidemark.operators.shaping import enforce
from tidemark.operators.incremental import read_mark
from tidemark.plans.feeds import DATE_PARTITION, FEEDS, HOURLY, needed_schema
from tidemark.plans.jobs import run_raw_to_clean
from tidemark.plans.pipelines import clean_mark, clean_rows
from tidemark.sources.documents import landed
from tidemark.sources.layers import Layer
from tidemark.sources.readers import read_raw
from tidemark.sources.staging import discard, staged, staging_path
from tidemark.workload.inputs import DOCUMENT_SCHEMA, documents_of, events


def best(run, times: int = 3) -> float:
    """Least of a few runs, after one that is not counted."""
    run()
    return round(min(seconds(run) for _ in range(times)), 3)


def split_by_row_ids(df: DataFrame, array: str, width: int) -> DataFrame:
    """The elements attached to the other columns by a join on generated row ids."""
    rest = df.drop(array).withColumn("left_id", F.monotonically_increasing_id())
    elements = df.select(
        *(F.get(column(array), F.lit(i)).alias(f"{array}[{i}]") for i in range(width))
    ).withColumn("right_id", F.monotonically_increasing_id())
    return rest.join(elements, F.col("left_id") == F.col("right_id")).drop("left_id", "right_id")


def cast_one_by_one(df: DataFrame, types: dict[str, str]) -> DataFrame:
    for name, data_type in types.items():
        df = df.withColumn(name, column(name).try_cast(data_type))
    return df


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cpus)
    results: dict[str, object] = {}
    json_path = staging_path(spark, "bench-json")
    rows = events(spark, sf_dir).repartition(8)
    with staged(documents_of(rows), "bench-documents") as documents:
        documents.write.json(json_path)
        for name, spec in FEEDS.items():
            clean = clean_rows(spec, documents)
            spent = best(lambda clean=clean: produce(clean))
            results[f"clean_{name}_rows_per_second"] = round(clean.count() / spent)

        wide = spark.range(1).select(*(F.col("id").alias(f"c{i}") for i in range(100)))
        types = {f"c{i}": "int" for i in range(100)}
        results["cast_100_columns"] = {
            "one_projection": best(lambda: enforce(wide, types).schema),
            "one_by_one": best(lambda: cast_one_by_one(wide, types).schema, 1),
        }

        arrays = documents.select("lat", "lon", "current.dt", "minutely")
        results["split_array"] = {
            "projection": best(lambda: produce(split_to_columns(arrays, "minutely", 6))),
            "row_id_join": best(lambda: produce(split_by_row_ids(arrays, "minutely", 6))),
        }

        def scan(schema):
            produce(clean_rows(HOURLY, read_raw(spark, json_path, schema)))

        def scan_landed():
            with landed(spark.read.text(json_path), DOCUMENT_SCHEMA) as batch:
                produce(clean_rows(HOURLY, batch.documents))

        results["json_hourly"] = {
            "schema_of_the_feed": best(lambda: scan(needed_schema([HOURLY], DOCUMENT_SCHEMA))),
            "schema_of_all": best(lambda: scan(DOCUMENT_SCHEMA)),
            "inferred": best(lambda: scan(None)),
            "landed": best(scan_landed),
        }

        # Arrays as long as real documents have them: an hour of minutes, two days of hours, a week.
        real = documents.select(*documents.columns[:5], *(
            F.array_repeat(F.element_at(array, 1), number).alias(array)
            for array, number in (("minutely", 60), ("hourly", 48), ("daily", 8))
        ))
        for name, spec in FEEDS.items():
            if spec.array is not None:
                results[f"clean_{name}_real_arrays"] = best(lambda spec=spec: produce(clean_rows(spec, real)), 1)

        layer = Layer(spark, staging_path(spark, "bench-layer"), DATE_PARTITION)
        layer.publish(clean_rows(FEEDS["current"], documents))
        frame = layer.read()
        results["mark"] = {
            "dates": len(layer.values()),
            "from_the_listing": best(lambda: clean_mark(layer)),
            "of_a_frame": best(lambda: read_mark(clean_mark(frame))),
        }

        target = staging_path(spark, "bench-clean")
        raw = read_raw(spark, json_path, DOCUMENT_SCHEMA)
        results["four_feeds_from_json"] = {
            "one_run": best(lambda: run_raw_to_clean(raw, target), 1),
            "four_runs": best(
                lambda: [run_raw_to_clean(raw, target, [spec]) for spec in FEEDS.values()], 1
            ),
        }
        discard(spark, target)
    discard(spark, json_path)
    print(json.dumps(results))
    spark.stop()


if __name__ == "__main__":
    main()
