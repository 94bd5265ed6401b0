import pytest

from tidemark import FEEDS, RAW_SCHEMA, raw_to_clean, read_layer, read_raw
from tidemark.streaming import (
    analytic_stream,
    clean_stream,
    read_layer_stream,
    read_raw_stream,
    start_layer,
)
from weather import DAY, HOUR, NOON, document, hour, write_json

HOURLY, CURRENT = FEEDS["hourly"], FEEDS["current"]


@pytest.fixture
def run(spark, tmp_path):
    """Clean whatever lies in the raw directory and has not been cleaned yet."""

    def go(spec):
        raw = read_raw_stream(spark, str(tmp_path / "raw"), RAW_SCHEMA, files_per_batch=1)
        rows = clean_stream(spec, raw)
        query = start_layer(rows, f"{tmp_path}/clean", f"{tmp_path}/checkpoint")
        query.awaitTermination(120)
        return read_layer(spark, f"{tmp_path}/clean")

    return go


def test_stream_gives_what_the_batch_gives(spark, tmp_path, run):
    documents = [document(NOON + i, hourly=[hour(NOON + HOUR * j) for j in range(i)])
                 for i in range(4)]
    path = write_json(tmp_path / "raw", documents)
    streamed = run(HOURLY)
    batch = raw_to_clean(HOURLY, read_raw(spark, path, RAW_SCHEMA))
    order = sorted(batch.columns)
    assert sorted(map(str, streamed.select(*(f"`{c}`" for c in order)).collect())) == sorted(
        map(str, batch.select(*(f"`{c}`" for c in order)).collect()))


def test_each_file_is_read_once_however_late_its_rows(spark, tmp_path, run):
    write_json(tmp_path / "raw", [document(NOON)])
    assert run(CURRENT).count() == 1
    write_json(tmp_path / "raw", [document(NOON - DAY), document(NOON + DAY), {"lat": 1.0}])
    assert run(CURRENT).count() == 3
    assert run(CURRENT).count() == 3


def test_analytic_stream_follows_the_clean_layer(spark, tmp_path, run):
    write_json(tmp_path / "raw", [document(NOON), document(NOON + DAY)])
    clean = run(CURRENT)
    stream = analytic_stream(
        CURRENT, read_layer_stream(spark, f"{tmp_path}/clean", clean.schema))
    start_layer(stream, f"{tmp_path}/analytic", f"{tmp_path}/checkpoint2").awaitTermination(120)
    analytic = read_layer(spark, f"{tmp_path}/analytic")
    assert analytic.count() == 2
    assert "current_weather_state" in analytic.columns
