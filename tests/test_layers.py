import glob
import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import FEEDS, RAW_SCHEMA, Layer, Table, read_layer, read_raw, run_clean_to_analytic, run_raw_to_clean
from tidemark.functions.schemas import united
from tidemark.plans import jobs
from tidemark.plans.pipelines import analytic_mark, clean_mark
from tidemark.sources import layers
from tidemark.sources.files import read_text
from tidemark.streaming import read_layer_stream
from weather import DAY, HOUR, LIMA, NOON, day, document, hour, write_json

CURRENT, HOURLY, DAILY = (FEEDS[name] for name in ("current", "hourly", "daily"))
PART = "current_weather_date_partition"


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        clean, analytic = str(tmp_path / "clean"), str(tmp_path / "analytic")
        batches = 0

        def raw(self, *documents, schema=None):
            self.batches += 1
            return read_raw(spark, write_json(tmp_path / f"raw-{self.batches}", documents), schema)

        def take(self, *documents, feeds=(CURRENT,), **options):
            options = {"overwrite": "touched", "log": 5} | options
            first = run_raw_to_clean(self.raw(*documents), self.clean, feeds, **options)
            return first, run_clean_to_analytic(spark, self.clean, self.analytic, feeds, by="changes")

        def layer(self, root, spec=CURRENT):
            return Layer(spark, f"{root}/{spec.name}", PART)

        def rows(self, root, *columns, spec=CURRENT):
            found = read_layer(spark, f"{root}/{spec.name}").select(*(f"`{c}`" for c in columns))
            return sorted(map(tuple, found.collect()), key=repr)

    return Place()


# --- Columns of all batches ---------------------------------------------------------------------


def test_conditions_of_all_batches_stay(place, spark):
    """One condition on day 10, three on day 11, then another place on day 11."""
    place.take(document(NOON, numbers=(1,)))
    place.take(document(NOON + DAY, numbers=(2, 3, 4)))
    place.take(document(NOON + DAY, place=LIMA, numbers=(5,)))
    names = [f"current_weather[{i}]_id" for i in range(3)]
    assert place.rows(place.clean, *names) == sorted([(1, None, None), (2, 3, 4), (5, None, None)], key=repr)
    assert place.rows(place.analytic, *names[1:]) == sorted([(None, None), (3, 4), (None, None)], key=repr)


def test_layer_of_another_program_is_read_whole(spark, tmp_path):
    path = str(tmp_path / "layer")
    for i, columns in enumerate(("1 AS a", "2 AS a, 'x' AS b", "3 AS a")):
        rows = spark.sql(f"SELECT {columns}, DATE'2024-01-0{i + 1}' AS d")
        rows.write.mode("append").partitionBy("d").parquet(path)
    assert set(read_layer(spark, path).columns) == {"a", "b", "d"}
    layer = Layer(spark, path, "d")
    assert layer.state() is None and layer.publish(spark.sql("SELECT 4 AS c, DATE'2024-01-02' AS d"), lambda new, old: new.unionByName(old))
    assert [f.name for f in layer.state().schema] == ["a", "b", "c", "d"]
    rows = sorted(map(tuple, read_layer(spark, path).collect()), key=repr)
    assert rows == sorted([(1, None, None, date(2024, 1, 1)), (2, "x", None, date(2024, 1, 2)), (None, None, 4, date(2024, 1, 2)), (3, None, None, date(2024, 1, 3))], key=repr)


def test_stored_schema_saves_opening_files(place, spark):
    place.take(document(NOON), document(NOON + DAY))
    for file in glob.glob(f"{place.clean}/current/*/*.parquet"):
        with open(file, "wb") as out:
            out.write(b"not parquet")
    assert "current_temp" in place.layer(place.clean).read().columns


def ddl(text):
    return StructType.fromDDL(text)


@pytest.mark.parametrize("old, new, both", [
    ("a int", "A bigint, b string", "a bigint, b string"),
    ("a float, b struct<x: int>", "b struct<y: int, x: double>", "a float, b struct<x: double, y: int>"),
    ("a array<struct<x: int>>", "a array<struct<z: date>>", "a array<struct<x: int, z: date>>"),
    ("a void, m map<string, int>", "a string, m map<string, bigint>", "a string, m map<string, bigint>"),
    ("a decimal(5,2)", "a decimal(9,2)", "a decimal(9,2)"),
])
def test_union_of_schemas(old, new, both):
    assert united(ddl(old), ddl(new)).simpleString() == ddl(both).simpleString()


@pytest.mark.parametrize("old, new", [("a string", "a int"), ("a bigint", "a double"), ("a date", "a timestamp"), ("a decimal(5,2)", "a decimal(5,1)")])
def test_types_that_do_not_go_together(old, new):
    with pytest.raises(ValueError, match="'a'"):
        united(ddl(old), ddl(new))


def test_wider_numbers_in_later_batches(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "layer"), "d")
    for row in ("1 AS a, CAST(0.5 AS FLOAT) AS b", "2L AS a, 0.1D AS b", "CAST(3 AS SMALLINT) AS a, CAST(2 AS FLOAT) AS b"):
        layer.publish(spark.sql(f"SELECT {row}, DATE'2024-01-01' AS d"), lambda new, old: new.unionByName(old))
    assert sorted((r["a"], r["b"]) for r in layer.read().collect()) == [(1, 0.5), (2, 0.1), (3, 2.0)]
    with pytest.raises(ValueError):
        layer.publish(spark.sql("SELECT 'x' AS a, DATE'2024-01-01' AS d"), lambda new, old: new.unionByName(old))
    assert layer.read().count() == 3


# --- Publishing ---------------------------------------------------------------------------------


def failing(rows):
    return rows.withColumn("a", F.when(F.col("a") > 1, F.raise_error("lost")).otherwise(F.col("a")))


@pytest.mark.parametrize("merge", [None, lambda new, old: new.unionByName(old)])
def test_failed_job_leaves_the_layer(spark, tmp_path, merge):
    layer = Layer(spark, str(tmp_path / "layer"), "d")
    layer.publish(spark.sql("SELECT 1 AS a, DATE'2024-01-01' AS d"))
    with pytest.raises(Exception, match="lost"):
        layer.publish(failing(spark.sql("SELECT id AS a, DATE'2024-01-01' AS d FROM range(1, 3)")), merge)
    assert [tuple(r) for r in layer.read().collect()] == [(1, date(2024, 1, 1))]
    assert os.listdir(tmp_path) == ["layer"]


class Broken(Exception):
    pass


@pytest.mark.parametrize("merge", [None, lambda new, old: new.unionByName(old)])
@pytest.mark.parametrize("step", range(18))
def test_publication_that_breaks_off_is_carried_out_by_the_next_reader(spark, tmp_path, monkeypatch, merge, step):
    """The driver is lost before the ``step``-th change of a folder: the layer holds the old rows
    where nothing was intended yet, else the new ones, and never a part of both."""
    path = str(tmp_path / "layer")
    layer = Layer(spark, path, "d")
    day_of = "DATE'2024-01-01' + CAST(id AS INT) AS d"
    layer.publish(spark.sql(f"SELECT id AS a, {day_of} FROM range(3)"))
    left = [step]

    def counted(change):
        def run(*arguments):
            if not left[0]:
                raise Broken
            left[0] -= 1
            return change(*arguments)
        return run

    with monkeypatch.context() as patch:
        for name in ("move", "discard", "write_text"):
            patch.setattr(layers, name, counted(getattr(layers, name)))
        try:
            layer.publish(spark.sql(f"SELECT id + 10 AS a, 'x' AS b, {day_of} FROM range(1, 3)"), merge, log=2)
        except Broken:
            pass
    rows = sorted((r["a"] for r in Layer(spark, path, "d").read().collect()))
    assert rows in ([0, 1, 2], [11, 12] if merge is None else [0, 1, 2, 11, 12])
    assert read_text(spark, f"{path}/_layer/intent.json") is None
    assert (len(rows) == 3) == ("b" not in Layer(spark, path, "d").read().columns)


def test_what_a_lost_driver_left_is_deleted(spark, tmp_path):
    left, other = (tmp_path / f"_fresh-{name}-{'0' * 32}" for name in ("layer", "layer-2"))
    left.mkdir()
    other.mkdir()
    Layer(spark, str(tmp_path / "layer"), "d").publish(spark.sql("SELECT 1 AS a, DATE'2024-01-01' AS d"))
    assert sorted(os.listdir(tmp_path)) == sorted(["layer", other.name])


def test_no_rows_publish_nothing(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "layer"), "d")
    nothing = spark.sql("SELECT 1 AS a, DATE'2024-01-01' AS d WHERE false")
    assert not layer.publish(nothing) and not os.listdir(tmp_path)
    assert layer.publish(spark.sql("SELECT 1 AS a, CAST(NULL AS DATE) AS d"))
    assert not layer.publish(nothing, lambda new, old: new) and layer.read().count() == 1
    assert layer.values() == [] and layer.newest("a", 2) is None
    assert layer.publish(spark.sql("SELECT 2 AS a, CAST(NULL AS DATE) AS d"), lambda new, old: new.unionByName(old))
    assert sorted(r["a"] for r in layer.read().collect()) == [1, 2]


def test_layer_of_a_stream_is_left_to_it(spark, tmp_path):
    (tmp_path / "layer" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="stream"):
        Layer(spark, str(tmp_path / "layer"), "d").publish(spark.sql("SELECT 1 AS a, DATE'2024-01-01' AS d"))
    with pytest.raises(ValueError, match="schema"):
        read_layer_stream(spark, str(tmp_path / "layer"))


def test_a_failed_feed_keeps_its_layer_and_the_others_run(place, spark, monkeypatch):
    documents = [document(NOON + DAY, hourly=[hour(NOON)], daily=[day(NOON)])]
    place.take(document(NOON, hourly=[hour(NOON)], daily=[day(NOON)]), feeds=(HOURLY, DAILY))
    rows = jobs.clean_rows

    def broken(spec, *arguments):
        found = rows(spec, *arguments)
        return found.withColumn("lat", F.raise_error("lost").cast("double")) if spec is HOURLY else found

    monkeypatch.setattr(jobs, "clean_rows", broken)
    with pytest.raises(Exception, match="lost"):
        run_raw_to_clean(place.raw(*documents), place.clean, (HOURLY, DAILY), overwrite="touched")
    assert len(place.rows(place.clean, "lat", spec=HOURLY)) == 1 and len(place.rows(place.clean, "lat", spec=DAILY)) == 2
    assert sorted(os.listdir(place.clean)) == ["daily", "hourly"]


# --- Marks --------------------------------------------------------------------------------------


def test_mark_opens_the_newest_files_only(place, spark):
    place.take(*(document(NOON + i * DAY) for i in range(8)))
    layer = place.layer(place.clean)
    for name in layer.values()[:5]:  # the newest date and the two before it are read
        for file in glob.glob(f"{layer.path}/{PART}={name}/*.parquet"):
            with open(file, "wb") as out:
                out.write(b"not parquet")
    assert clean_mark(layer) == NOON + 7 * DAY
    assert analytic_mark(place.layer(place.analytic)) == datetime.fromtimestamp(NOON + 7 * DAY, timezone.utc)


def test_mark_walks_back_where_the_newest_dates_have_no_value(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "layer"), "d")
    layer.publish(spark.sql("SELECT IF(id = 2, 7, NULL) AS a, DATE'2024-01-01' + CAST(id AS INT) AS d FROM range(9)"))
    assert layer.newest("a", 2) == 7
    assert Layer(spark, str(tmp_path / "none"), "d").newest("a", 2) is None


def test_mark_and_columns_of_a_catalog_table(spark):
    table = Table(spark, "rows", "d", "layers_of_tests")
    try:
        assert table.newest("a", 2) is None and not table.dated()
        table.append(spark.sql("SELECT 1 AS a, DATE'2024-01-01' AS d"))
        table.append(spark.sql("SELECT 'x' AS b, 5 AS a, DATE'2024-01-09' AS d"))
        table.append(spark.sql("SELECT 3 AS a, DATE'2024-01-05' AS d"))
        assert table.values() == ["2024-01-01", "2024-01-05", "2024-01-09"] and table.dated()
        assert table.newest("a", 2) == 5
        assert sorted(map(tuple, table.read().select("a", "b").collect()), key=repr) == [(1, None), (3, None), (5, "x")]
        assert spark.catalog.currentDatabase() == "default"
    finally:
        spark.sql("DROP DATABASE layers_of_tests CASCADE")


# --- Changes ------------------------------------------------------------------------------------


def test_late_rows_reach_the_second_hop(place, spark):
    place.take(document(NOON))
    first, second = place.take(document(NOON - HOUR, place=LIMA))
    assert [r.written for r in (*first, *second)] == [True, True]
    assert len(place.rows(place.analytic, "lat")) == 2


def test_second_hop_reads_only_what_changed(place, spark):
    place.take(document(NOON))
    place.take(document(NOON, place=LIMA))
    analytic, clean = place.layer(place.analytic), place.layer(place.clean)
    assert analytic.taken(clean) == clean.state().version == 2
    assert clean.changes(2) is None and clean.changes(1).count() == 1 and clean.changes(0).count() == 2
    again = run_clean_to_analytic(spark, place.clean, place.analytic, [CURRENT], by="changes")
    assert not again[0].written and analytic.state().version == 2


def test_log_that_does_not_reach_back_gives_the_whole_layer(place, spark):
    for i in range(4):
        run_raw_to_clean(place.raw(document(NOON + i)), place.clean, [CURRENT], overwrite="touched", log=2)
    layer = place.layer(place.clean)
    assert sorted(os.listdir(f"{layer.path}/_layer/changes")) == ["3", "4"]
    assert layer.changes(2).count() == 2 and layer.changes(1).count() == layer.changes(0).count() == 4
    run_clean_to_analytic(spark, place.clean, place.analytic, [CURRENT], by="changes")
    run_raw_to_clean(place.raw(document(NOON + 9)), place.clean, [CURRENT], log=2)  # replaces everything
    assert layer.changes(4).count() == 1


def test_corrections_replace_rows(place):
    place.take(document(NOON), document(NOON, place=LIMA))
    changed = document(NOON)
    changed["current"]["humidity"] = 5
    place.take(changed)
    assert place.rows(place.analytic, "current_humidity") == [(5,), (81,)]


def test_corrections_that_are_taken_together(place, spark):
    """Two runs of the first hop before one of the second: of a row the later one counts."""
    for humidity in (1, 2, 3):
        changed, other = document(NOON), document(NOON + humidity, place=LIMA)
        changed["current"]["humidity"] = other["current"]["humidity"] = humidity
        run_raw_to_clean(place.raw(changed, other), place.clean, [CURRENT], overwrite="touched", log=5)
    run_clean_to_analytic(spark, place.clean, place.analytic, [CURRENT], by="changes")
    assert place.rows(place.analytic, "current_humidity") == [(1,), (2,), (3,), (3,)]
    assert place.rows(place.clean, "current_humidity") == [(1,), (2,), (3,), (3,)]


# --- One pass -----------------------------------------------------------------------------------


@pytest.mark.parametrize("feeds", [[HOURLY], [CURRENT], [FEEDS["minutely"]], list(FEEDS.values())])
def test_raw_documents_are_parsed_once(place, spark, feeds):
    raw = place.raw(document(NOON, numbers=(1, 2), hourly=[hour(NOON)], daily=[day(NOON)], minutely=[{"dt": NOON, "precipitation": 1.5}]), schema=RAW_SCHEMA)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    results = run_raw_to_clean(raw.mapInArrow(count, raw.schema), place.clean, feeds)
    assert all(r.written for r in results) and seen.value == 1
    if CURRENT in feeds:
        assert place.rows(place.clean, "current_weather[1]_id") == [(2,)]


def test_each_place_by_its_own_mark(place, spark):
    place.take(document(NOON), feeds=(CURRENT, HOURLY))
    history = {"current": place.layer(place.clean)}
    options = {"history": history, "keys": ("lat", "lon")}
    first, _ = place.take(document(NOON - DAY, place=LIMA), document(NOON - DAY), **options)
    assert first[0].written and len(place.rows(place.clean, "lat")) == 2
    first, _ = place.take(document(NOON - DAY, place=LIMA), document(NOON), **options)
    assert not first[0].written


def test_marks_of_keys_meet_a_narrow_exchange(spark, plan):
    from tidemark.operators.incremental import newer_than_per_key

    rows = spark.sql("SELECT id % 50 AS place, id AS dt, repeat('x', 100) AS wide FROM range(3000)")
    newer = newer_than_per_key(rows, "dt", rows.where("dt < 1500"), ["place"], narrow=True)
    assert newer.count() == 1500 and newer.columns == rows.columns
    late = newer_than_per_key(rows, "dt", spark.sql("SELECT 7L AS place, 2000L AS dt"), ["place"], lookback=100, narrow=True)
    assert late.count() == 3000 - 60 + 22 and late.where("place = 7").agg(F.min("dt")).first()[0] == 1907


def test_options_of_the_jobs(place, spark):
    twice = document(NOON)
    run_raw_to_clean(place.raw(twice, twice), place.clean, [CURRENT, HOURLY], dedupe=True, outer=True)
    assert len(place.rows(place.clean, "lat")) == 1
    with pytest.raises(ValueError):
        run_raw_to_clean(place.raw(twice), place.clean, [CURRENT], overwrite="some")
