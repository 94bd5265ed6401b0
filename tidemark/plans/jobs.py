"""The hops with their reads and writes: watermark, increment, gate, overwrite."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial, reduce
from operator import and_
from typing import Literal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.casts import CastMode
from tidemark.functions.naming import column
from tidemark.operators.incremental import Mark, newer_than, read_mark
from tidemark.plans.feeds import (
    DATE_PARTITION,
    FEEDS,
    OBSERVATION,
    OBSERVATION_DT,
    OBSERVATION_EPOCH,
    WEATHER_TIME,
    FeedSpec,
)
from tidemark.plans.pipelines import (
    History,
    analytic_mark,
    analytic_rows,
    clean_mark,
    clean_rows,
    needs_width,
    new_documents,
    raw_conditions,
)
from tidemark.sources.layers import Layer
from tidemark.sources.staging import staged
from tidemark.sources.writers import Overwrite, compact, require_apart

ALL_FEEDS = tuple(FEEDS.values())


@dataclass(frozen=True)
class HopResult:
    """What one run of a hop did for one feed."""

    feed: str
    mark: Mark
    written: bool


def layer_path(root: str, spec: FeedSpec) -> str:
    """Directory of a feed below the root of its layer."""
    return f"{root.rstrip('/')}/{spec.name}"


def _value(mark: DataFrame | Mark) -> Mark:
    return read_mark(mark) if isinstance(mark, DataFrame) else mark


@dataclass(frozen=True)
class Seen:
    """What the pass that stages documents saw of them, for one feed."""

    #: Elements of the longest array, 1 for a feed that is the observation itself.
    elements: int
    #: Weather conditions of the longest array of them.
    conditions: int


@contextmanager
def staged_documents(raw: DataFrame, feeds: Sequence[FeedSpec], marks: Mapping[str, Mark] | None = None
                     ) -> Iterator[tuple[DataFrame, dict[str, Seen]]]:
    """Documents that are news to any of ``feeds``, staged as Parquet for as long as the block
    lasts, and what was seen of the news of each feed.

    They are parsed and filtered in one pass; the widths that columns depend on, and whether a
    feed has anything to write, are observed by that pass, so no other one looks for them."""
    wanted = _needed(raw, feeds)
    own = {}
    for spec in feeds:
        newer = F.lit(True)
        if marks is not None:
            newer = F.col(OBSERVATION_EPOCH) > marks[spec.name] - spec.lookback
        elements = F.lit(1) if spec.array is None else F.size(column(spec.array))
        conditions = raw_conditions(spec, wanted.schema)
        own[f"{spec.name} elements"] = F.max(F.when(newer, elements))
        own[f"{spec.name} conditions"] = F.max(F.when(newer, F.lit(0) if conditions is None else conditions))
    if marks is not None:
        wanted = newer_than(wanted, OBSERVATION_EPOCH, min(marks[spec.name] - spec.lookback for spec in feeds))
    observation = Observation()
    observed = wanted.observe(observation, *(value.alias(name) for name, value in own.items()))
    with staged(observed, "raw-increment") as documents:
        found = {name: max(value or 0, 0) for name, value in observation.get.items()}
        yield documents, {spec.name: Seen(found[f"{spec.name} elements"], found[f"{spec.name} conditions"]) for spec in feeds}


def run_raw_to_clean(raw: DataFrame, clean_root: str, feeds: Iterable[FeedSpec] = ALL_FEEDS,
                     history: Mapping[str, History] | None = None,
                     overwrite: Overwrite = "all", compacted: bool = False,
                     stage: bool | None = None, keys: Sequence[str] = (), dedupe: bool = False,
                     mode: CastMode = "try_cast", outer: bool = False, log: int = 0) -> list[HopResult]:
    """Write the clean increment of each feed below ``clean_root``.

    ``history`` holds, by feed name, what was cleaned before, as a frame, a layer or a table; a
    feed without one starts from nothing. The raw documents are parsed once for all feeds: those
    newer than the oldest mark are staged as Parquet, and the pass that stages them tells the
    widths of their arrays and which feeds have news. From there each feed reads its own fields
    and increment. A feed whose increment gives no row, or whose array an inferred schema does
    not even have, is not written, so its last output stays. A feed that fails does not keep the
    others from being written, nor does it harm its layer; the errors are raised at the end.
    ``stage=False`` reads ``raw`` for each feed instead, and once more for widths, which is right
    for documents that are columnar already; it is the default only where one feed of fixed
    columns is run.

    ``overwrite="touched"`` keeps the rows of a date that the increment does not replace, by
    place, observation and forecast time, and the columns of all batches. ``log`` is the number
    of runs whose rows are kept apart, for the second hop to take them from
    (``by="changes"``).

    ``keys``, ``dedupe``, ``mode`` and ``outer`` are those of
    :func:`~tidemark.plans.pipelines.raw_to_clean`; with ``keys`` every feed takes its news from
    ``raw`` on its own, and the mark reported is that of all keys.

    Every task writes a file for each date it meets. An increment spans few dates; for a
    backfill over many, ``compacted`` brings the rows of a date together first."""
    feeds, history = tuple(feeds), history or {}
    marks = {spec.name: _value(clean_mark(history.get(spec.name))) for spec in feeds}
    present = [spec for spec in feeds if spec.array is None or spec.array in raw.columns]
    written, errors = set(), []

    def put(spec: FeedSpec, documents: DataFrame, longest: int | None = None) -> None:
        try:
            rows = clean_rows(spec, documents, mode, outer, longest)
            layer = Layer(raw.sparkSession, layer_path(clean_root, spec), DATE_PARTITION)
            if _publish(spec, layer, rows.dropDuplicates() if dedupe else rows, overwrite, compacted, log):
                written.add(spec.name)
        except Exception as error:
            errors.append(error)

    def newer(spec: FeedSpec, documents: DataFrame) -> DataFrame:
        return newer_than(documents, OBSERVATION_EPOCH, marks[spec.name], spec.lookback)

    if keys:
        for spec in present:
            news = new_documents(spec, _needed(raw, [spec]), history.get(spec.name), keys)
            with staged_documents(news, [spec]) as (documents, seen):
                put(spec, documents, seen[spec.name].conditions)
    elif stage or (stage is None and present and (len(present) > 1 or needs_width(present[0]))):
        with staged_documents(raw, present, marks) as (documents, seen):
            for spec in present:
                if seen[spec.name].elements or outer:
                    put(spec, newer(spec, documents), seen[spec.name].conditions)
    else:
        for spec in present:
            put(spec, newer(spec, raw))
    _raise(errors)
    return [HopResult(spec.name, marks[spec.name], spec.name in written) for spec in feeds]


def run_clean_to_analytic(spark: SparkSession, clean_root: str, analytic_root: str,
                          feeds: Iterable[FeedSpec] = ALL_FEEDS,
                          history: Mapping[str, History] | None = None,
                          overwrite: Overwrite = "all", lookback: int = 0,
                          compacted: bool | None = None, dedupe: bool = False,
                          by: Literal["mark", "changes"] = "mark", log: int = 0) -> list[HopResult]:
    """Write the analytic increment of each feed below ``analytic_root``, from the clean
    layer below ``clean_root`` and by the ``history`` of analytic rows. Whether rows of a date
    are brought together is up to the feed unless ``compacted`` says so. A feed without a clean
    layer yet has nothing to write, and one that fails does not keep the others from running.

    ``by="changes"`` takes the rows that the clean layer's log has since the last run of this
    hop, instead of rows beyond a mark. So late rows come along, none comes twice, and no older
    one is read. The analytic layer grows (``overwrite`` is ``"touched"``), and stores with its
    rows how far it has come. Where the log does not reach back, the whole clean layer is taken."""
    history = history or {}
    results, errors = [], []
    for spec in feeds:
        try:
            require_apart(layer_path(clean_root, spec), layer_path(analytic_root, spec))
            clean = Layer(spark, layer_path(clean_root, spec), DATE_PARTITION)
            analytic = Layer(spark, layer_path(analytic_root, spec), DATE_PARTITION)
            mark = _value(analytic_mark(history.get(spec.name)))
            rows, took = None, None
            if by == "changes":
                state = clean.state()
                rows = clean.changes(analytic.taken(clean), partial(merged, spec))
                took = None if state is None else (clean, state.version)
            elif clean.exists():
                rows = newer_than(clean.read(), WEATHER_TIME, mark, lookback, DATE_PARTITION)
            done = False
            if rows is not None:
                rows = analytic_rows(spec, rows)
                done = _publish(spec, analytic, rows.dropDuplicates() if dedupe else rows,
                                "touched" if by == "changes" else overwrite,
                                spec.compact if compacted is None else compacted, log, took)
            results.append(HopResult(spec.name, mark, done))
        except Exception as error:
            errors.append(error)
    _raise(errors)
    return results


def _raise(errors: list[Exception]) -> None:
    if len(errors) == 1:
        raise errors[0]
    if errors:
        raise ExceptionGroup("several feeds failed", errors)


def _needed(raw: DataFrame, feeds: Iterable[FeedSpec]) -> DataFrame:
    """What the feeds read of the raw documents; of the observation often just its time."""
    names = dict.fromkeys(name for spec in feeds for name in spec.raw_columns)
    if all(spec.array is not None for spec in feeds):
        time = column(OBSERVATION, OBSERVATION_DT).alias(OBSERVATION_DT)
        raw = raw.withColumn(OBSERVATION, F.struct(time))
    return raw.select(*names)


def merged(spec: FeedSpec, rows: DataFrame, old: DataFrame) -> DataFrame:
    """``rows``, and those of ``old`` that none of them replaces. Rows are the same if place,
    observation and forecast time are."""
    new = rows.select(*(column(name).alias(f"__new_{name}") for name in spec.grain)).distinct()
    same = reduce(and_, (column(name).eqNullSafe(F.col(f"__new_{name}")) for name in spec.grain))
    return rows.unionByName(old.join(new, same, "left_anti"), allowMissingColumns=True)


def _publish(spec: FeedSpec, layer: Layer, rows: DataFrame, overwrite: Overwrite, compacted: bool,
             log: int = 0, took: tuple[Layer, int] | None = None) -> bool:
    if overwrite not in ("all", "touched"):
        raise ValueError(f"unknown way to overwrite: {overwrite!r}")
    return layer.publish(
        rows,
        merge=partial(merged, spec) if overwrite == "touched" else None,
        prepare=partial(compact, by=DATE_PARTITION) if compacted else None,
        log=log, took=took,
    )
