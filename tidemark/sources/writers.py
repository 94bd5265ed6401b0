"""Writing layers as Parquet directories, one per value of the partition columns."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame

Overwrite = Literal["all", "touched"]

_OVERWRITE_MODES = {"all": "static", "touched": "dynamic"}


def compact(df: DataFrame, by: str | Sequence[str], n: int | None = None) -> DataFrame:
    """Bring rows of one partition value together, so that each directory gets few files.

    The rebalancing is adaptive: small values share a task, and one that outgrows the
    advisory size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), as a date with a
    third of all rows would, is split over several tasks and files. ``n`` is the number of
    shuffle partitions to start from."""
    columns = [by] if isinstance(by, str) else list(by)
    return df.hint("rebalance", *([] if n is None else [n]), *columns)


def require_apart(source: str, target: str) -> None:
    """Raise if one path lies within the other. Replacing a directory deletes it before its
    rows are read; to rewrite a layer in place, stage the new rows first."""
    inner, outer = (f"{path.rstrip('/')}/" for path in (source, target))
    if inner.startswith(outer) or outer.startswith(inner):
        raise ValueError(f"{target!r} would be overwritten while {source!r} is read")


def write_partitioned(df: DataFrame, path: str, by: str | Sequence[str],
                      overwrite: Overwrite = "all",
                      max_records_per_file: int | None = None) -> None:
    """Write ``df``, which must not read from ``path``, to one directory per value of ``by``.

    ``all`` replaces everything below ``path``, ``touched`` only the directories ``df`` has
    rows for. Both are set on the write itself, so no session setting changes the outcome."""
    columns = [by] if isinstance(by, str) else list(by)
    writer = (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", _OVERWRITE_MODES[overwrite])
        .partitionBy(*columns)
    )
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
