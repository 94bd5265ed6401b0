"""Schemas that hold what several others hold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StructField,
    StructType,
)

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
#: Whole numbers that a double holds exactly, as Parquet's readers widen them.
_SMALL = (ByteType, ShortType, IntegerType)

Key = Callable[[str], str]
#: What becomes of two types that do not go together.
Otherwise = Callable[[DataType, DataType], DataType]


def _number(old: DataType, new: DataType) -> DataType | None:
    if isinstance(old, _WHOLE) and isinstance(new, _WHOLE):
        return max(old, new, key=lambda t: _WHOLE.index(type(t)))
    if {type(old), type(new)} <= {FloatType, DoubleType}:
        return DoubleType()
    for one, other in ((old, new), (new, old)):
        if isinstance(one, DoubleType) and isinstance(other, _SMALL):
            return one
    if isinstance(old, DecimalType) and isinstance(new, DecimalType) and old.scale == new.scale:
        return max(old, new, key=lambda t: t.precision)
    return None


def widened(old: DataType, new: DataType, name: str = "", key: Key = str.lower,
            otherwise: Otherwise | None = None) -> DataType:
    """A type that holds the values of both: structs have the fields of both, of numbers the
    wider one counts. Where there is none that stored values of both can be read as, ``otherwise``
    names one, or an error is raised."""
    if isinstance(old, NullType) or old == new:
        return new
    if isinstance(new, NullType):
        return old
    if isinstance(old, StructType) and isinstance(new, StructType):
        return united(old, new, key, f"{name}.", otherwise)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        element = widened(old.elementType, new.elementType, f"{name}[]", key, otherwise)
        return ArrayType(element, old.containsNull or new.containsNull)
    if isinstance(old, MapType) and isinstance(new, MapType) and old.keyType == new.keyType:
        value = widened(old.valueType, new.valueType, f"{name}[]", key, otherwise)
        return MapType(old.keyType, value, old.valueContainsNull or new.valueContainsNull)
    number = _number(old, new)
    if number is None and otherwise is not None:
        return otherwise(old, new)
    if number is None:
        raise ValueError(f"{name!r} is {old.simpleString()} in one batch and {new.simpleString()} in another")
    return number


def united(old: StructType, new: StructType, key: Key = str.lower, above: str = "",
           otherwise: Otherwise | None = None) -> StructType:
    """The fields of ``old`` in their order, then those that only ``new`` has; types of common
    fields are :func:`widened`, and all may be NULL, as rows of either lack some."""
    others = {key(field.name): field for field in new}
    fields = []
    for field in old:
        other = others.pop(key(field.name), None)
        kind = field.dataType
        if other is not None:
            kind = widened(kind, other.dataType, above + field.name, key, otherwise)
        fields.append(StructField(field.name, kind))
    fields += [StructField(field.name, field.dataType) for field in new if key(field.name) in others]
    return StructType(fields)
