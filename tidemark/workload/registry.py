"""Queries by name, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import TimestampType

from tidemark.functions.naming import aliased, quoted

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries and the SQL that states their results."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str) -> Callable[[Query], Query]:
        """Register the decorated query under ``name``."""
        if name in self.queries:
            raise ValueError(f"query {name!r} is already registered")

        def register(query: Query) -> Query:
            self.queries[name] = query
            self.sql[name] = sql
            return query

        return register


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock time in UTC, the way the SQL side holds them."""
    return df.selectExpr(
        *(
            aliased(f"CAST({quoted(field.name)} AS TIMESTAMP_NTZ)", field.name)
            if isinstance(field.dataType, TimestampType)
            else quoted(field.name)
            for field in df.schema
        )
    )
