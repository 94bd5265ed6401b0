"""Casts that either fail or give NULL on values the target type cannot hold."""

from __future__ import annotations

from typing import Literal

from pyspark.sql.types import DataType, NumericType, StringType

CastMode = Literal["cast", "try_cast"]

#: Bounds, exclusive, of what a number may be before its fraction is cut off.
_BOUNDS = {
    "int": (-(2**31) - 1, 2**31),
    "smallint": (-(2**15) - 1, 2**15),
    "tinyint": (-(2**7) - 1, 2**7),
}
#: Text that reads as a number with or without a fraction, padded or not.
_SPACE = "[ \t\n\r\f\v]*"
_WHOLE_OR_DECIMAL = f"^{_SPACE}[+-]?[0-9]+([.][0-9]*)?{_SPACE}$"
_SPELLINGS = {"integer": "int", "short": "smallint", "byte": "tinyint"}


def type_name(data_type: DataType | str) -> str:
    """Name of a type as SQL spells it."""
    name = data_type if isinstance(data_type, str) else data_type.simpleString()
    return _SPELLINGS.get(name.lower(), name)


def cast_as(expression: str, to: DataType | str, mode: CastMode = "try_cast",
            source: DataType | None = None) -> str:
    """SQL text that casts ``expression``; ``try_cast`` turns what does not fit into NULL,
    ``cast`` follows the session's ANSI setting.

    Where ``source``, the type of the expression, is known, values are checked before they
    are cast to a small integer: ``try_cast`` by itself raises and catches an exception for
    each value that does not fit, which costs microseconds a row. Text loses its fraction as
    numbers do, ``'12.7'`` becomes 12."""
    name = type_name(to)
    if mode not in ("cast", "try_cast"):
        raise ValueError(f"unknown cast mode {mode!r}")
    if mode == "try_cast" and name in _BOUNDS:
        if isinstance(source, NumericType):
            low, high = _BOUNDS[name]
            fits = f"{expression} > {low} AND {expression} < {high}"
            return f"CASE WHEN {fits} THEN CAST({expression} AS {name}) END"
        if isinstance(source, StringType):
            whole = f"substring_index({expression}, '.', 1)"
            reads = f"{expression} RLIKE '{_WHOLE_OR_DECIMAL}'"
            return f"CASE WHEN {reads} THEN try_cast({whole} AS {name}) END"
    return f"{mode}({expression} AS {name})"
