import glob
import os

import pytest

from tidemark import FEEDS, RAW_SCHEMA, read_layer, read_raw
from tidemark import run_clean_to_analytic, run_raw_to_clean
from tidemark.__main__ import main
from tidemark.plans.jobs import layer_path
from tidemark.sources.staging import staging_root
from weather import DAY, HOUR, LIMA, NOON, day, document, hour, minute, write_json


def full(dt, **place):
    return document(dt, **place, hourly=[hour(dt), hour(dt + HOUR)], daily=[day(dt)],
                    minutely=[minute(dt, 1.5), minute(dt + 60, 2.5), minute(dt + 120, 0.5)])


SIZES = {"current": 1, "daily": 1, "hourly": 2, "minutely": 3}


@pytest.fixture
def place(spark, tmp_path):
    """Paths, and histories that an outside copy of each output would build up."""

    class Place:
        raw, clean, analytic = (str(tmp_path / n) for n in ("raw", "clean", "analytic"))
        copies = {"clean": {}, "analytic": {}}

        def land(self, *documents):
            write_json(tmp_path / "raw", documents)

        def copy(self, layer, results):
            for result in results:
                if result.written:
                    source = layer_path(getattr(self, layer), FEEDS[result.feed])
                    target = str(tmp_path / f"{layer}-history" / result.feed)
                    read_layer(spark, source).write.mode("append").parquet(target)
                    self.copies[layer][result.feed] = target

        def history(self, layer):
            return {f: spark.read.parquet(p) for f, p in self.copies[layer].items()}

        def run(self):
            raw = read_raw(spark, self.raw, RAW_SCHEMA)
            first = run_raw_to_clean(raw, self.clean, history=self.history("clean"))
            self.copy("clean", first)
            second = run_clean_to_analytic(
                spark, self.clean, self.analytic, history=self.history("analytic")
            )
            self.copy("analytic", second)
            return first, second

        def rows(self, layer):
            root = getattr(self, layer)
            return {f: read_layer(spark, layer_path(root, s)).count() for f, s in FEEDS.items()}

    return Place()


def written(results):
    return {r.feed for r in results if r.written}


def test_first_run_writes_all_feeds_with_one_directory_per_date(place):
    place.land(full(NOON), full(NOON + DAY))
    first, second = place.run()
    assert written(first) == written(second) == set(FEEDS)
    assert {r.mark for r in first} == {0}
    for layer in ("clean", "analytic"):
        assert place.rows(layer) == {f: 2 * n for f, n in SIZES.items()}
        assert len(glob.glob(f"{place.analytic}/current/current_weather_date_partition=*")) == 2


def test_second_run_holds_only_what_is_new(place):
    place.land(full(NOON))
    place.run()
    place.land(full(NOON + DAY), full(NOON + 2 * DAY, place=LIMA))
    first, second = place.run()
    assert {r.mark for r in first} == {NOON}
    # The hourly feed reads three days again; the analytic layer does not take them twice.
    assert place.rows("clean") == {"current": 2, "daily": 2, "hourly": 6, "minutely": 6}
    assert place.rows("analytic") == {"current": 2, "daily": 2, "hourly": 4, "minutely": 6}
    assert written(second) == set(FEEDS)


def test_run_without_news_leaves_the_last_output(place):
    place.land(full(NOON))
    place.run()
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{place.analytic}/*/*/*.parquet")}
    first, second = place.run()
    assert written(first) == {"hourly"}
    assert written(second) == set()
    assert before == {
        f: os.stat(f).st_mtime_ns for f in glob.glob(f"{place.analytic}/*/*/*.parquet")
    }


def test_feed_without_elements_is_not_written(place, spark):
    place.land(document(NOON))
    results = run_raw_to_clean(read_raw(spark, place.raw, RAW_SCHEMA), place.clean)
    assert written(results) == {"current"}
    assert os.listdir(place.clean) == ["current"]


def test_late_report_beyond_the_mark_is_lost_but_for_the_hourly_look_back(place):
    place.land(full(NOON))
    place.run()
    place.land(full(NOON - HOUR, place=LIMA))
    first, second = place.run()
    assert written(first) == {"hourly"}
    assert place.rows("clean")["hourly"] == 4
    assert written(second) == set()


def test_staging_is_cleared(place, spark):
    place.land(full(NOON))
    place.run()
    assert not glob.glob(f"{staging_root(spark)}/tidemark/*/raw-increment-*")


def test_columnar_documents_need_no_staging(place, spark, tmp_path):
    place.land(full(NOON))
    read_raw(spark, place.raw, RAW_SCHEMA).write.parquet(str(tmp_path / "columnar"))
    columnar = spark.read.parquet(str(tmp_path / "columnar"))
    results = run_raw_to_clean(columnar, place.clean, stage=False)
    assert written(results) == set(FEEDS)
    assert place.rows("clean") == SIZES


def test_raw_documents_are_parsed_once_for_all_feeds(place, spark):
    place.land(full(NOON))
    raw = read_raw(spark, place.raw, RAW_SCHEMA)
    spark.sparkContext.setJobGroup("hop", "one run of the hop")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    run_raw_to_clean(raw.mapInArrow(count, raw.schema), place.clean)
    assert seen.value == 1


def test_touched_dates_only(place, spark):
    place.land(full(NOON), full(NOON + DAY))
    place.run()
    history = place.history("clean")
    place.land(full(NOON + DAY + 1))
    run_raw_to_clean(read_raw(spark, place.raw, RAW_SCHEMA), place.clean, [FEEDS["current"]],
                     history, overwrite="touched")
    rows = read_layer(spark, f"{place.clean}/current").select("current_dt").collect()
    assert sorted(r[0] for r in rows) == [NOON, NOON + DAY, NOON + DAY + 1]


def test_touched_rows_are_replaced_by_grain(place, spark):
    place.land(full(NOON), full(NOON + 1))
    place.run()
    raw = read_raw(spark, place.raw, RAW_SCHEMA)
    for _ in range(2):
        run_raw_to_clean(raw, place.clean, overwrite="touched")
    rows = read_layer(spark, f"{place.clean}/hourly")
    assert rows.count() == 2 * SIZES["hourly"] == rows.distinct().count()


def test_second_hop_after_a_feed_without_rows(place, spark):
    place.land(document(NOON))
    run_raw_to_clean(read_raw(spark, place.raw, None), place.clean)
    assert written(run_clean_to_analytic(spark, place.clean, place.analytic)) == {"current"}


def test_backfill_over_many_dates_can_be_compacted(place, spark):
    for i in range(3):
        place.land(*(full(NOON + d * DAY + i) for d in range(5)))
    raw = read_raw(spark, place.raw, RAW_SCHEMA).repartition(6)
    hourly = [FEEDS["hourly"]]
    run_raw_to_clean(raw, place.clean, hourly)
    loose = len(glob.glob(f"{place.clean}/hourly/*/*.parquet"))
    run_raw_to_clean(raw, place.clean, hourly, compacted=True)
    assert len(glob.glob(f"{place.clean}/hourly/*/*.parquet")) == 5 <= loose
    assert read_layer(spark, f"{place.clean}/hourly").count() == 30


def test_batch_without_an_array_leaves_that_feed_alone(place, spark):
    place.land(document(NOON, hourly=[hour(NOON)]))
    raw = read_raw(spark, place.raw, None)
    results = run_raw_to_clean(raw, place.clean)
    assert [r.feed for r in results] == list(FEEDS)
    assert written(results) == {"current", "hourly"}
    assert written(run_raw_to_clean(raw, place.clean, [FEEDS["daily"]])) == set()


def test_command_line_runs_both_hops(place, spark, capsys):
    place.land(full(NOON))
    main(["clean", "--raw", place.raw, "--out", place.clean])
    main(["analytic", "--clean", place.clean, "--out", place.analytic, "--feed", "daily"])
    assert os.listdir(place.analytic) == ["daily"]
    place.land(full(NOON + 1))
    main(["clean", "--raw", place.raw, "--out", place.clean, "--feed", "current", "--infer",
          "--history", f"current={place.clean}/current"])
    printed = capsys.readouterr().out
    assert "hourly: newer than 0: written" in printed
    assert f"current: newer than {NOON}: written" in printed
    spark.sql("SELECT 2000000000 AS current_dt").createOrReplaceTempView("far_future")
    main(["clean", "--raw", place.raw, "--out", place.clean, "--feed", "current",
          "--history", "current=far_future"])
    assert "current: newer than 2000000000: nothing new" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["clean", "--raw", place.raw, "--out", place.clean, "--history", "nonsense"])
