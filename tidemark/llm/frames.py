"""What the operators' frames have in common."""

from __future__ import annotations

import math
import threading
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.staging import discard, staging_path

#: Jobs delete their shuffle files when they end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names the operators use inside. Whatever else the
    input holds, under whatever name, cannot clash with those."""
    return df.select(*(df[old].alias(new) for new, old in columns.items()))


_lock = threading.Lock()
#: Settings that blocks hold at the moment: how many do, and what was set before the first.
_held: dict[str, tuple[int, str | None]] = {}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings of the session for the time of a block. Of blocks that overlap, in several threads,
    the last one to end puts back what was set before the first."""
    with _lock:
        for name, value in values.items():
            number, before = _held.get(name, (0, None))
            _held[name] = number + 1, spark.conf.get(name, None) if number == 0 else before
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _lock:
            for name in values:
                number, before = _held.pop(name)
                if number > 1:
                    _held[name] = number - 1, before
                elif before is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, before)


#: Where :func:`kept` notes what it writes, for whoever knows when that is done with.
_noted: list[list[str]] = []


@contextmanager
def noting(paths: list[str]):
    """Tables that are kept within the block are added to ``paths``."""
    _noted.append(paths)
    try:
        yield
    finally:
        _noted.pop()


def note(path: str) -> None:
    """Add a folder to the tables of the block it is made in."""
    if _noted:
        _noted[-1].append(path)


def kept(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once to the folder all executors share, and read back.

    Cuts the lineage: a lost executor costs its own tasks, not what led up to here. The
    shuffle files behind it go when it is written. The folder lies below
    ``spark.checkpoint.dir`` and lasts as long as the frames that read it may."""
    spark = df.sparkSession
    path = path or staging_path(spark, name)
    note(path)
    writer = df.write.mode("errorifexists").option("compression", "none" if "data" in df.columns else "zstd")
    with settings(spark, {_CLEANUP: "true"}):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, name: str, work: Callable[[], DataFrame]) -> DataFrame:
    """What ``work`` returns, written; the tables that it kept on the way are deleted, whether or
    not it succeeds."""
    paths: list[str] = []
    try:
        with noting(paths):
            result = work()
        return kept(result, name)
    finally:
        for path in paths:
            discard(spark, path)


def text_bytes(df: DataFrame, column: str = "text") -> tuple[int, int]:
    """Rows, and bytes of all texts: what partition counts are derived from."""
    rows, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(column).cast("long"))).first()
    return rows, size or 0


def parts(size: float, each: float, least: int = 12) -> int:
    """How many parts make each about ``each`` large."""
    return max(least, math.ceil(size / each))
