"""Exact deduplication by a stateful stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import cut, kept, note, settings
from tidemark.sources.files import folders
from tidemark.sources.staging import staging_path

#: State lies on disk. Without preallocation, a partition takes no more of it than it needs. All
#: partitions of an executor share one bound on what they hold in memory, and are closed soon
#: after the stream has ended.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}
#: What texts are compared without.
WHITE = "".join(chr(c) for c in (0x20, *range(0x09, 0x0E)))


def normalised(text: Column) -> Column:
    """A text without any blank, tab or line end; NULL is empty."""
    return F.coalesce(F.translate(text, WHITE, ""), F.lit(""))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def track(arrivals: DataFrame, changes: str, checkpoint: str) -> None:
    """Run a stream of ``digest, doc_id, length`` over all that has arrived, and write how the
    state changed, each batch in a folder of its own below ``changes``. Rows may come in loads,
    with ``load`` falling, and with a ``locator``.

    The state, on executors' disks in RocksDB and behind the checkpoint, holds for each digest how
    many rows had it and which stays, of the first load: its stable id, its length, and the
    locator of its content. It never expires. A rerun from the same checkpoint goes on where the last one ended; a batch
    that is repeated writes the same folder again."""
    spark = arrivals.sparkSession
    state = arrivals.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"), F.max(_order(arrivals)).alias("first"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch={number}")

    with settings(spark, _STATE):
        run = (state.writeStream.outputMode("update").foreachBatch(write)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        run.awaitTermination()


def _order(arrivals: DataFrame | None = None) -> Column:
    """Greatest for the row that stays: the longest, then the one of the smallest id; a NULL id
    comes last. The id's bitwise complement is the larger, the smaller it is. Of ``arrivals`` the
    load comes first, and the locator is carried along."""
    named = [] if arrivals is None else arrivals.columns
    return F.struct(
        *(["load"] if "load" in named else []), F.col("length"), F.col("doc_id").isNotNull().alias("known"),
        F.bitwise_not("doc_id").alias("turned"), *(["locator"] if "locator" in named else []))


def _described(docs: DataFrame, doc_id: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Rows with what they are compared by. The locator is a hash of the original text: with its id
    and length it names the row in the table the text came from, without a copy of the text."""
    return cut(docs, doc_id=doc_id, text=text).withColumn("bare", normalised(F.col("text"))).select(
        "doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("length"), F.xxhash64("text").alias("locator"), "bare",
        digest(F.col("bare")).alias("digest"), sha256(F.col("bare")).alias("text_sha256"))


def _tracked(rows: DataFrame, base: str, number: int) -> tuple[DataFrame, DataFrame]:
    """Take ``rows`` up in the state below ``base`` as arrivals ``number``; returns them, and the
    state's last word on each digest it has ever seen."""
    spark = rows.sparkSession
    arrived = kept(rows.drop("bare").withColumn("load", F.lit(-number)), "arrivals", f"{base}/arrivals/{number}")
    stream = spark.readStream.schema(arrived.schema).parquet(f"{base}/arrivals/*")
    track(stream, f"{base}/changes", f"{base}/checkpoint")
    changes = spark.read.option("basePath", f"{base}/changes").parquet(f"{base}/changes/*")
    return arrived, _last(changes)


def _last(changes: DataFrame) -> DataFrame:
    """What the state last said of each digest."""
    last = changes.groupBy("digest").agg(F.max(F.struct("batch", "rows", "first")).alias("last"))
    return last.select("digest", "last.rows", "last.first")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Groups of texts that are equal but for blanks, tabs and line ends.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``, a row for a row. Of a group, the
    longest original text stays, then the smallest id. NULL texts are empty, and equal each
    other; a NULL id stays only where no other row has its length. Rows repeated with their id
    count, and are all marked as kept if their id stays and their length is the longest. Other
    columns take no part, whatever their names; an empty table gives no rows, and texts of any
    length are compared whole.

    Digests go through the stream of :func:`track`. Where one was seen more than once, the full
    texts are compared by grouping them by all their bytes, so texts that share a digest and
    differ stay apart; only those rows are shuffled with their texts. Hot groups are added up
    before any shuffle. The state goes with the query; :func:`deduplicate_new` keeps it."""
    base = staging_path(docs.sparkSession, "dedup")
    note(base)
    rows = _described(docs, doc_id, text, digest)
    arrived, groups = _tracked(rows, base, 0)
    alone = arrived.join(groups.where(F.col("rows") == 1).select("digest"), "digest").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    hits = rows.join(groups.where(F.col("rows") > 1).select("digest"), "digest")
    exact = hits.groupBy("digest", "bare").agg(F.count(F.lit(1)).alias("group_size"), F.max(_order()).alias("first"))
    marked = hits.join(exact, ["digest", "bare"]).select(
        "doc_id", F.bitwise_not("first.turned").alias("keep_id"), "group_size",
        (F.col("doc_id").eqNullSafe(F.bitwise_not("first.turned")) & (F.col("length") == F.col("first.length"))).alias("kept"),
        "text_sha256")
    return alone.unionByName(marked)


def deduplicate_new(docs: DataFrame, earlier: DataFrame | None, state: str, doc_id: str = "doc_id", text: str = "text",
                    digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Judge a load of new documents against all loads before, whose state is kept at ``state``, a
    folder that the caller names and all executors share.

    ``earlier`` holds the documents of the loads before; what was once kept stays kept, so of a
    text that came before no row of this load is. Returns ``doc_id, keep_id, group_size, kept,
    text_sha256`` for the rows of this load; ``group_size`` counts all loads. Only the rows that
    the state's locators name are fetched from ``earlier`` and compared by their bytes.

    A digest whose bytes differ from those of the row that its state names is grouped by bytes
    within this load. Such texts are told apart from each other and from the named row, but not
    from a third text of an earlier load with the same digest."""
    spark = docs.sparkSession
    loads = folders(spark, f"{state}/arrivals")
    rows = _described(docs, doc_id, text, digest)
    before = None
    if loads:
        changes = spark.read.option("basePath", f"{state}/changes").parquet(f"{state}/changes/*")
        before = kept(_last(changes), "state")  # as it was: the load below changes it
    _tracked(rows, state, len(loads))
    own = rows.groupBy("digest", "bare").agg(F.count(F.lit(1)).alias("own"), F.max(_order()).alias("here"))
    if before is None or earlier is None:
        judged = own.select("digest", "bare", F.col("own").alias("group_size"), "here", F.lit(False).alias("old"), F.lit(None).cast("long").alias("old_id"))
    else:
        seen = before.join(rows.select("digest").distinct(), "digest", "left_semi")
        named = seen.select("digest", "rows", F.bitwise_not("first.turned").alias("old_id"), F.col("first.locator").alias("locator"))
        held = cut(earlier, doc_id=doc_id, text=text).withColumn("locator", F.xxhash64("text"))
        same = held["doc_id"].eqNullSafe(named["old_id"]) & (held["locator"] == named["locator"])
        content = held.join(named, same).select("digest", "rows", "old_id", normalised(F.col("text")).alias("bare")).dropDuplicates(["digest"])
        judged = own.join(content, ["digest", "bare"], "left").select(
            "digest", "bare", (F.col("own") + F.coalesce("rows", F.lit(0))).alias("group_size"), "here", F.col("rows").isNotNull().alias("old"), "old_id")
    here = F.bitwise_not("here.turned")
    first = F.col("doc_id").eqNullSafe(here) & (F.col("length") == F.col("here.length"))
    return rows.join(judged, ["digest", "bare"]).select(
        "doc_id", F.when(F.col("old"), F.col("old_id")).otherwise(here).alias("keep_id"), "group_size", (~F.col("old") & first).alias("kept"), "text_sha256")
