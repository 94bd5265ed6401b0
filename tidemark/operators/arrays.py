"""Arrays to rows, and arrays to columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidemark.functions.naming import (
    aliased,
    column,
    quoted,
    require_columns,
    require_distinct,
    same_name,
)
from tidemark.operators.nested import flatten_struct, flatten_structs

Namer = Callable[[str, int], str]


def _array_type(df: DataFrame, name: str) -> ArrayType:
    require_columns(df, [name])
    key = same_name(df)
    data_type = next(f.dataType for f in df.schema if key(f.name) == key(name))
    if not isinstance(data_type, ArrayType):
        raise TypeError(f"{name!r} is {data_type.simpleString()}, not an array")
    return data_type


def _others(df: DataFrame, name: str) -> list[str]:
    key = same_name(df)
    return [other for other in df.columns if key(other) != key(name)]


def explode_prefix(df: DataFrame, array: str, prefix: str, outer: bool = False,
                   with_pos: bool = False, sep: str = "_") -> DataFrame:
    """One row per element; a struct element becomes columns ``<prefix><sep><field>``.

    Rows whose array is null or empty vanish unless ``outer``. ``with_pos`` adds the 0-based
    ``<prefix><sep>pos``. No shuffle: each row is expanded where it lies.

    The inner form is an outer explode without the rows that have no position: for a plain
    inner explode the optimizer adds a filter on the array's size, which computes the array a
    second time wherever it is an expression, such as parsed JSON text."""
    element = _array_type(df, array).elementType
    rest = _others(df, array)
    pos = f"{prefix}{sep}pos"
    require_distinct(df, [*rest, pos, prefix])
    rows = df.selectExpr(
        *map(quoted, rest),
        f"posexplode_outer({quoted(array)}) AS ({quoted(pos)}, {quoted(prefix)})",
    )
    if not outer:
        rows = rows.where(column(pos).isNotNull())
    if not with_pos:
        rows = rows.drop(pos)
    return flatten_struct(rows, prefix, sep) if isinstance(element, StructType) else rows


def max_length(df: DataFrame, array: str) -> int:
    """Length of the longest array, 0 if there is none. Runs a job over that one column."""
    _array_type(df, array)
    longest = df.agg(F.max(F.size(column(array)))).first()[0]
    return max(longest or 0, 0)


def bracketed(array: str, i: int) -> str:
    """Name of the ``i``-th column an array is split into, as Spark itself would call it."""
    return f"{array}[{i}]"


def split_to_columns(df: DataFrame, array: str, width: int | None = None,
                     namer: Namer = bracketed) -> DataFrame:
    """Replace ``array`` by columns ``<array>[0]`` … ``<array>[width - 1]`` at the end, NULL
    beyond an array's length. ``namer`` gives them other names.

    A fixed ``width`` gives every batch one schema and costs no job; without it the longest
    array of the batch decides, as :func:`max_length` finds it."""
    _array_type(df, array)
    if width is None:
        width = max_length(df, array)
    rest = _others(df, array)
    names = [namer(array, i) for i in range(width)]
    require_distinct(df, [*rest, *names])
    return df.selectExpr(
        *map(quoted, rest),
        *(aliased(f"get({quoted(array)}, {i})", name) for i, name in enumerate(names)),
    )


def first_struct(df: DataFrame, array: str, width: int = 1, sep: str = "_",
                 namer: Namer = bracketed) -> DataFrame:
    """Split an array of structs and flatten the elements: ``<array>[0]_<field>``, …

    The columns exist, as NULLs, even if every array of the batch is empty."""
    element = _array_type(df, array).elementType
    if not isinstance(element, StructType):
        raise TypeError(f"{array!r} holds {element.simpleString()}, not structs")
    promoted = [namer(array, i) for i in range(width)]
    return flatten_structs(split_to_columns(df, array, width, namer), promoted, sep, deep=True)
