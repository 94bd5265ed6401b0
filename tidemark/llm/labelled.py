"""Labelled documents that the classifiers learn from, and how they score the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from tidemark.llm.frames import cut


def fold(doc_id: str, folds: int) -> Column:
    """The fold of a document: the CRC-32 of its id as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int, size: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``bound`` of the labelled texts that ``learn`` holds for,
    and of at most ``size`` bytes in all, chosen by a hash of the id. A document labelled twice
    counts once, as the larger label; rows that repeat an id and its text count once; the texts of
    one id are texts of their own. NULL ids and labels take no part, nor do texts of more than a
    64th of all bytes.

    The bounds are applied to hashes and sizes of the texts, in one pass over them. What is chosen
    comes to the driver as an id, a hash and a label for each text, at most ``bound`` of them, and is
    broadcast to where the texts are. Only texts that do repeat are shuffled, to have one of each."""
    chosen = (
        cut(labels, doc_id="doc_id", label=label).dropna().where(learn & F.col("label").isin(0, 1))
        .groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    own = cut(docs, doc_id="doc_id", text="text").withColumn("key", F.xxhash64("text"))
    held = own.join(F.broadcast(chosen), "doc_id").select("doc_id", "key", "label", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("key")]
    each = held.where(F.col("size") <= size // 64).groupBy("doc_id", "key", "label", "size").agg(F.count(F.lit(1)).alias("copies"))
    picked, total = [], 0
    for row in each.orderBy(*order).limit(bound).collect():
        total += row["size"]
        if total > size:
            break
        picked.append((row["doc_id"], row["key"], row["label"], row["copies"] > 1))
    schema = StructType([chosen.schema["doc_id"], StructField("key", LongType()), StructField("label", IntegerType()), StructField("repeats", BooleanType())])
    texts = own.join(F.broadcast(docs.sparkSession.createDataFrame(picked, schema)), ["doc_id", "key"])
    if any(repeats for *_, repeats in picked):
        texts = texts.where(~F.col("repeats")).union(texts.where("repeats").dropDuplicates(["doc_id", "key"]))
    return texts.select("doc_id", "text", "label")


def judged(scored: DataFrame, held_out: Column, threshold: float) -> DataFrame:
    """``doc_id, held_out, score, predicted`` from ``doc_id, score``."""
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

