"""Names of columns that nested data is spread over."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Quote one column name, so that dots and brackets in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def path(*names: str) -> str:
    """SQL text for what lies at ``names``, from a top-level name into nested fields."""
    return ".".join(map(quoted, names))


def column(*names: str) -> Column:
    """Column for what lies at ``names``, from a top-level name into nested fields."""
    return F.col(path(*names))


def aliased(expression: str, name: str) -> str:
    """SQL text that gives ``expression`` a name. Projections over many columns are written
    as text, which reaches Spark in one call per column instead of one per function."""
    return f"{expression} AS {quoted(name)}"


def same_name(df: DataFrame):
    """Key under which the session holds two column names to be the same."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return str
    return str.lower


def require_distinct(df: DataFrame, names: Iterable[str]) -> None:
    """Raise if two output columns would carry one name, e.g. ``a_b`` beside ``a.b``."""
    key = same_name(df)
    seen: dict[str, str] = {}
    for name in names:
        if key(name) in seen:
            raise ValueError(f"columns {seen[key(name)]!r} and {name!r} would share one name")
        seen[key(name)] = name


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise if ``df`` lacks one of ``names``."""
    key = same_name(df)
    present = {key(name) for name in df.columns}
    missing = [name for name in names if key(name) not in present]
    if missing:
        raise ValueError(f"no column {', '.join(map(repr, missing))} among {df.columns}")
