"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import delete_at_exit, discard, path_exists


def staging_root(spark: SparkSession) -> str:
    """The cluster's shared folder, as ``spark.checkpoint.dir`` names it. Only a session that
    runs in one process, as in tests, may do without; it gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def staging_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses. What is left there goes when the
    application ends."""
    own = f"{staging_root(spark)}/tidemark/{spark.sparkContext.applicationId}"
    if not path_exists(spark, own):
        delete_at_exit(spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written once as Parquet and read back, for as long as the block lasts.

    Later jobs prune its columns and push filters into it, and start from files instead of
    ``df``'s lineage, so a lost executor costs no recomputation beyond its own tasks. The files
    have no dictionaries, which take longer to build than they save in a few reads."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    try:
        df.write.mode("errorifexists").option("parquet.enable.dictionary", "false").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        discard(spark, path)
