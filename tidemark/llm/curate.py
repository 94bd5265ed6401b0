"""Operators as filters of documents: rows go or change, columns stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import neardup, streams, suffixes
from tidemark.llm.frames import kept

#: Columns that only these functions see, under names no table has.
_ID, _NULL, _SHA, _CRC, _BODY = (f"curate: {name}" for name in ("id", "no id", "digest", "crc", "body"))


def without_copies(docs: DataFrame) -> DataFrame:
    """Of rows with equal texts (see :func:`streams.deduplicate`) one stays. If several rows have
    the id that stays, it is the longest of them, then the one with the greatest values."""
    found = kept(streams.deduplicate(docs).select("doc_id", "kept", "text_sha256"), "copies")
    bare = streams.sha256(streams.normalised(F.col("text")))
    marked = docs.withColumn(_SHA, bare).withColumn(_ID, F.coalesce("doc_id", F.lit(0))).withColumn(_NULL, F.col("doc_id").isNull())
    names = F.coalesce("doc_id", F.lit(0)).alias(_ID), F.col("doc_id").isNull().alias(_NULL), F.col("text_sha256").alias(_SHA)
    keys = [_ID, _NULL, _SHA]
    rows = found.groupBy(*names).agg(F.max("kept").alias("some"), F.count(F.lit(1)).alias("rows"))
    gone = rows.where(~F.col("some")).select(*keys)
    left = marked.join(gone, keys, "left_anti")
    again = kept(rows.where(F.col("some") & (F.col("rows") > 1)).select(*keys), "repeated")
    if not again.isEmpty():
        order = F.struct(F.coalesce(F.char_length("text"), F.lit(0)), *(F.col(f"`{c}`") for c in docs.columns))
        one = left.join(again, keys).groupBy(*keys).agg(F.max(order).alias("best")).select("best.*")
        one = one.select(*(F.col(f"`{c}`") for c in one.columns[1:]))
        return left.join(again, keys, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns)).union(one)
    return left.drop(*keys)


def without_near_copies(docs: DataFrame) -> DataFrame:
    """Of each group of near-duplicates (see :func:`neardup.near_duplicates`) the document of the
    smallest id stays; rows of one id stay or go together, and NULL ids stay."""
    found = neardup.near_duplicates(docs)
    gone = found.groupBy("doc_id").agg(F.max("kept").alias("some")).where(~F.col("some")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_repeats(docs: DataFrame) -> DataFrame:
    """Texts without the bytes that recur from documents of smaller ids (see
    :func:`suffixes.remove_repeats`), and ``n_chars``, where there is one, as they then are. Every
    row stays, if with an empty text; a NULL text stays NULL, and so does all of a NULL id's row."""
    found = suffixes.remove_repeats(docs, with_text=True).where(F.col("doc_id").isNotNull())
    found = found.select(F.col("doc_id").alias(_ID), F.col("crc").alias(_CRC), F.col("body").alias(_BODY)).groupBy(_ID, _CRC).agg(F.first(_BODY).alias(_BODY))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")))
    # The text itself is not shuffled once more: only whether there is one.
    rest = docs.where(F.col("doc_id").isNotNull()).withColumn(_ID, F.col("doc_id").cast("long")).withColumn(_CRC, crc)
    rest = rest.withColumn("text", F.when(F.col("text").isNotNull(), F.lit(""))).join(found, [_ID, _CRC])
    changed = rest.withColumn("text", F.when(F.col("text").isNotNull(), F.col(_BODY)))
    if "n_chars" in docs.columns:
        size = F.coalesce(F.char_length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", size)
    return changed.select(*docs.columns).union(docs.where(F.col("doc_id").isNull()))
