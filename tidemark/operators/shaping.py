"""Names, types and order of the columns of a layer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructField

from tidemark.functions.casts import CastMode, cast_as, type_name
from tidemark.functions.naming import (
    aliased,
    quoted,
    require_columns,
    require_distinct,
    same_name,
)


def _differs(field: StructField, wanted: DataType | str | None) -> bool:
    return wanted is not None and type_name(wanted) != field.dataType.simpleString()


def enforce(df: DataFrame, types: Mapping[str, DataType | str],
            mode: CastMode = "try_cast") -> DataFrame:
    """Cast the columns named in ``types``, all in one projection. Names that are absent are
    skipped, columns that are not named pass through."""
    key = same_name(df)
    wanted = {key(name): data_type for name, data_type in types.items()}
    return df.selectExpr(
        *(
            aliased(
                cast_as(quoted(field.name), wanted[key(field.name)], mode, field.dataType),
                field.name,
            )
            if _differs(field, wanted.get(key(field.name)))
            else quoted(field.name)
            for field in df.schema
        )
    )


def rename_drop(df: DataFrame, renames: Mapping[str, str] | None = None,
                drops: Iterable[str] = ()) -> DataFrame:
    """Rename, then drop. Absent names are ignored."""
    renamed = df.withColumnsRenamed(dict(renames or {}))
    require_distinct(renamed, renamed.columns)
    return renamed.drop(*drops)


def reorder(df: DataFrame, leading: Sequence[str],
            rest: Literal["sorted", "drop"] = "sorted") -> DataFrame:
    """Put ``leading`` first; the remaining columns follow by name, or are dropped."""
    require_columns(df, leading)
    key = same_name(df)
    first = {key(name) for name in leading}
    if rest == "sorted":
        others = sorted(name for name in df.columns if key(name) not in first)
    elif rest == "drop":
        others = []
    else:
        raise ValueError(f"unknown rule {rest!r} for the remaining columns")
    return df.selectExpr(*map(quoted, (*leading, *others)))
