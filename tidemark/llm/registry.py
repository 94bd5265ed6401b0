"""The queries of this subpackage by name, with SQL where SQL can state the result."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.frames import settled

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_SHIPPED = "tidemark.llm.shipped"


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python, once for each application; it is all they
    need, wherever the driver found it."""
    context = spark.sparkContext
    if spark.conf.get(_SHIPPED, "") == context.applicationId:
        return
    root = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="tidemark-code-")  # the driver serves it while it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "tidemark").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(str(archive))
    spark.conf.set(_SHIPPED, context.applicationId)


def query(name: str, sql: str | None = None, settle: bool = False) -> Callable[[Query], Query]:
    """Register the decorated query. With ``settle`` its result is written, and the tables that it
    kept on the way are deleted; it is for operators that keep any."""

    def register(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return settled(spark, name, lambda: function(spark, sf_dir)) if settle else function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register
