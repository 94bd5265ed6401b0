"""Spreading structs over flat columns.

The schema is walked on the driver; every operator is then a single projection, however
deep or wide the structs are."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from tidemark.functions.naming import aliased, path, require_columns, require_distinct, same_name

Leaf = tuple[str, tuple[str, ...]]


def _holds_array(data_type: DataType) -> bool:
    if isinstance(data_type, ArrayType):
        return True
    if isinstance(data_type, StructType):
        return any(_holds_array(field.dataType) for field in data_type)
    if isinstance(data_type, MapType):
        return _holds_array(data_type.keyType) or _holds_array(data_type.valueType)
    return False


def struct_columns(schema: StructType, with_arrays: bool = True) -> list[str]:
    """Names of the struct columns, with or without those that hold an array somewhere."""
    return [
        field.name
        for field in schema
        if isinstance(field.dataType, StructType)
        and (with_arrays or not _holds_array(field.dataType))
    ]


def _leaves(name: str, above: tuple[str, ...], struct: StructType, sep: str, deep: bool,
            into_arrays: bool) -> Iterator[Leaf]:
    """Output name and path of the fields below ``above``, of nested structs too if ``deep``."""
    for field in struct:
        flat, below = f"{name}{sep}{field.name}", (*above, field.name)
        opens = (
            deep
            and isinstance(field.dataType, StructType)
            and (into_arrays or not _holds_array(field.dataType))
        )
        if opens:
            yield from _leaves(flat, below, field.dataType, sep, deep, into_arrays)
        else:
            yield flat, below


def flatten_structs(df: DataFrame, names: Iterable[str], sep: str = "_", deep: bool = False,
                    into_arrays: bool = True) -> DataFrame:
    """Replace each struct of ``names``, in place, by its fields called
    ``<name><sep><field>``; no field is lost, whatever the widths.

    ``deep`` goes on into structs below, ``into_arrays=False`` then leaves those whole that
    hold an array."""
    names = list(names)
    require_columns(df, names)
    key = same_name(df)
    chosen = {key(name) for name in names}
    leaves: list[Leaf] = []
    for field in df.schema:
        at = (field.name,)
        if key(field.name) not in chosen:
            leaves.append((field.name, at))
        elif isinstance(field.dataType, StructType):
            leaves.extend(_leaves(field.name, at, field.dataType, sep, deep, into_arrays))
        else:
            raise TypeError(f"{field.name!r} is {field.dataType.simpleString()}, not a struct")
    require_distinct(df, (name for name, _ in leaves))
    return df.selectExpr(*(aliased(path(*at), name) for name, at in leaves))


def flatten_struct(df: DataFrame, name: str, sep: str = "_") -> DataFrame:
    """:func:`flatten_structs` for one column, one level."""
    return flatten_structs(df, [name], sep)


def flatten_all(df: DataFrame, sep: str = "_", into_arrays: bool = False) -> DataFrame:
    """Flatten structs of any depth. Structs that hold an array are left whole unless
    ``into_arrays``; arrays themselves are never opened."""
    names = struct_columns(df.schema, with_arrays=into_arrays)
    return flatten_structs(df, names, sep, deep=True, into_arrays=into_arrays) if names else df
