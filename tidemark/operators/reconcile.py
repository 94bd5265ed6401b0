"""Merging columns that hold one value in several types, ``<base>_int`` and ``<base>_double``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, MapType, NumericType, StructType

from tidemark.functions.casts import CastMode, cast_as
from tidemark.functions.naming import aliased, quoted, require_distinct

#: Suffixes of the type variants. Earlier ones win where a row holds more than one.
VARIANT_SUFFIXES = ("_double", "_int")


def variant_groups(columns: Iterable[str],
                   suffixes: Sequence[str] = VARIANT_SUFFIXES) -> dict[str, list[str]]:
    """Group variant columns by base name: bases in order of first sight, members in order
    of ``suffixes``. Only a whole suffix counts, so ``x_interval`` is no variant and ``rain``
    does not take in ``rain_1h_int``."""
    columns = list(columns)
    found: dict[str, dict[str, str]] = {}
    for name in columns:
        for suffix in suffixes:
            if name.endswith(suffix) and len(name) > len(suffix):
                found.setdefault(name.removesuffix(suffix), {})[suffix] = name
                break
    return {
        base: [members[suffix] for suffix in suffixes if suffix in members]
        for base, members in found.items()
    }


def merge_variants(df: DataFrame, groups: Mapping[str, Sequence[str]] | None = None,
                   target_type: DataType | str = "double",
                   mode: CastMode = "try_cast") -> DataFrame:
    """Replace each group by its first non-null member, as ``target_type``, at the end.

    ``groups`` defaults to :func:`variant_groups`. The members are cast before the choice, so
    an integer beside a double loses nothing; ``float`` rounds to 32 bits."""
    if groups is None:
        groups = variant_groups(df.columns)
    if not groups:
        return df
    members = {name for group in groups.values() for name in group}
    rest = [name for name in df.columns if name not in members]
    require_distinct(df, [*rest, *groups])

    def first_of(group: Sequence[str]) -> str:
        return f"coalesce({', '.join(cast_as(quoted(name), target_type, mode) for name in group)})"

    return df.selectExpr(
        *map(quoted, rest),
        *(aliased(first_of(group), base) for base, group in groups.items()),
    )


def _is_variant(data_type: DataType, members: Sequence[str]) -> bool:
    return (
        isinstance(data_type, StructType) and len(data_type) > 0
        and all(f.name in members and isinstance(f.dataType, NumericType) for f in data_type)
    )


def _within(expression: str, data_type: DataType, target: DataType | str, mode: CastMode,
            members: Sequence[str], depth: int = 0) -> str | None:
    """SQL text that merges the variants anywhere within ``expression``; None if it has none."""
    if _is_variant(data_type, members):
        present = [name for name in members if name in data_type.names]
        return f"coalesce({', '.join(cast_as(f'{expression}.{quoted(name)}', target, mode) for name in present)})"
    each = f"each{depth}"
    if isinstance(data_type, StructType):
        fields = [(f.name, f"{expression}.{quoted(f.name)}", f.dataType) for f in data_type]
        merged = [_within(text, kind, target, mode, members, depth) for _, text, kind in fields]
        if not any(merged):
            return None
        parts = (f"{new or text} AS {quoted(name)}" for (name, text, _), new in zip(fields, merged))
        return f"CASE WHEN {expression} IS NOT NULL THEN struct({', '.join(parts)}) END"
    if isinstance(data_type, ArrayType):
        element = _within(each, data_type.elementType, target, mode, members, depth + 1)
        return None if element is None else f"transform({expression}, {each} -> {element})"
    if isinstance(data_type, MapType):
        value = _within(each, data_type.valueType, target, mode, members, depth + 1)
        return None if value is None else f"transform_values({expression}, (key{depth}, {each}) -> {value})"
    return None


def merge_variants_within(df: DataFrame, columns: Iterable[str] | None = None,
                          target_type: DataType | str = "double", mode: CastMode = "try_cast",
                          members: Sequence[str] = ("double", "int")) -> DataFrame:
    """Replace every struct of nothing but variants, such as ``struct<int, double>``, by its first
    non-null member as ``target_type``, in place, however deep in structs, arrays and maps it
    lies. The schema is walked on the driver; rows are rewritten where they lie, and a frame
    without such structs is returned as it is. NULL structs and elements stay NULL."""
    wanted = None if columns is None else set(columns)
    rewritten = {
        field.name: _within(quoted(field.name), field.dataType, target_type, mode, members)
        for field in df.schema if wanted is None or field.name in wanted
    }
    if not any(rewritten.values()):
        return df
    return df.selectExpr(*(
        aliased(rewritten[name], name) if rewritten.get(name) else quoted(name) for name in df.columns
    ))
