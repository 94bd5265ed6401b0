"""Ranked search by terms: hashed max-sketches bound the scores, exact rescoring settles them."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, IntegralType, LongType, StructField, StructType

from tidemark.llm.frames import cut, kept, settled
from tidemark.llm.terms import frequencies, terms

#: Coordinates of a sketch; terms are hashed to them.
WIDTH = 1 << 16
#: Items that are looked up together.
ITEMS = 256
#: Most pairs of an item and a document, of some 30 bytes each, that are sent to all tasks.
SENT = 200_000
#: Numbers of a dense block of impacts (rows of documents x coordinates the items ask for).
BLOCK = 1 << 22

# Fixed values of the score.
_SCALE, _GAIN, _LENGTH, _SHARE = 1_000_000_000, 1000, 12, 25


def weight(documents: int, holding: int) -> int:
    """Weight of a term that ``holding`` of ``documents`` documents hold; never below 0."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def damping(n, documents: int, total: int):
    """What the length ``n`` of a document adds to its term counts."""
    return 100 - _SHARE + (_SHARE * n * documents) // max(total, 1)


def impact(tf, m):
    """What ``tf`` occurrences of a term are worth in a document with damping ``m``. It grows
    with ``tf``, so the largest impact in a coordinate is that of the largest count."""
    return (_SCALE * tf) // (_GAIN * tf + _LENGTH * m)


def coordinate(term: bytes) -> int:
    return zlib.crc32(term) & (WIDTH - 1)


def counted(text: bytes) -> Counter:
    """Occurrences of each term of a text."""
    counts: Counter = Counter()
    for piece in terms(text):
        counts.update(piece)
    return counts


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index, a row for each document with a term: ``doc_id``, ``key`` (hash of the text),
    ``n`` terms, and the sketch as ``places`` (16-bit coordinates that are not zero, ascending)
    and ``counts`` (the largest count of a term in each).

    Impacts depend on how long documents are on average, counts do not; so the sketch keeps the
    maxima of counts, which are the maxima of impacts whatever the average, and holds when the
    table grows. It depends on no query either, and is smaller than the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, places, counts = [], [], [], []
            for i, value in enumerate(batch.column(2)):
                found = counted(value.as_py() or b"")
                if found:
                    at = np.fromiter(map(coordinate, found), np.int64, len(found))
                    tf = np.fromiter(found.values(), np.int64, len(found))
                    order = np.argsort(at, kind="stable")
                    own, first = np.unique(at[order], return_index=True)
                    most = np.maximum.reduceat(tf[order], first)
                    rows.append(i)
                    sizes.append(int(tf.sum()))
                    places.append(own.astype(np.uint16).tobytes())
                    counts.append(most.astype(np.uint8 if most.max() < 256 else np.uint32).tobytes())
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(sizes, pa.int64()), pa.array(places, pa.binary()), pa.array(counts, pa.binary())],
                ["doc_id", "key", "n", "places", "counts"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return _keyed(docs, doc_id, text).mapInArrow(run, f"doc_id {kind}, key long, n long, places binary, counts binary")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, a hash of the text, and the text's bytes. Rows that agree in both are alike."""
    rows = cut(docs, doc_id=doc_id, text=text).where(F.col("text").isNotNull())
    return rows.select("doc_id", F.xxhash64("text").alias("key"), F.col("text").cast("binary").alias("body"))


@dataclass(frozen=True)
class Queries:
    """A block of items with what the corpus says about their terms."""

    ids: list
    #: Occurrences of each term, by item.
    terms: list[dict[bytes, int]]
    weights: dict[bytes, int]
    documents: int
    total: int

    def lookup(self) -> tuple[np.ndarray, np.ndarray]:
        """Column of each coordinate (-1: no item asks for it), and the weight that an item gives
        to each column."""
        asked = sorted({coordinate(term) for own in self.terms for term in own})
        column = np.full(WIDTH, -1, dtype=np.int64)
        column[asked] = np.arange(len(asked))
        weights = np.zeros((len(asked), len(self.ids)))
        for i, own in enumerate(self.terms):
            for term, times in own.items():
                weights[column[coordinate(term)], i] += times * self.weights[term]
        return column, weights


def _bounds(index: pa.RecordBatch, queries: Queries, column: np.ndarray, weights: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Upper bounds of the scores, documents x items, for ranges of documents from a first one.

    The numbers are whole and below 2**53, so doubles hold them exactly."""
    step = max(16, BLOCK // max(1, column.max() + 1))
    m = damping(np.asarray(index.column("n")), queries.documents, queries.total)
    for start in range(0, index.num_rows, step):
        part = index.slice(start, step)
        dense = np.zeros((part.num_rows, weights.shape[0]))
        for row, (at, tf) in enumerate(zip(part.column("places"), part.column("counts"))):
            at, tf = np.frombuffer(at.as_py(), np.uint16), tf.as_py()
            tf = np.frombuffer(tf, np.uint8 if len(tf) == at.size else np.uint32)
            own = column[at]
            asked = own >= 0
            dense[row, own[asked]] = impact(tf[asked].astype(np.int64), m[start + row])
        yield start, dense @ weights


def _bounded(index: DataFrame, queries: Queries, k: int, floors: list[tuple] | None) -> DataFrame:
    """``item, doc_id, key, bound`` by number of the item: without ``floors`` the ``k`` largest
    bounds that a task meets, with them every row that may still be among an item's best ``k``.

    A floor is the ``k``-th best score known of an item, and the id that holds it if ids are
    whole numbers: of equal scores the smaller ids win."""
    whole = isinstance(index.schema["doc_id"].dataType, IntegralType)
    least = np.array([max(score, 1) for score, _ in floors or [(1, None)] * len(queries.ids)], dtype=float)
    last = np.array([np.iinfo(np.int64).max if i is None or not whole else i for _, i in floors or [(0, None)] * len(queries.ids)])

    def ids_of(batch: pa.RecordBatch) -> np.ndarray:
        column = batch.column("doc_id")
        return np.asarray(column.cast(pa.int64()).fill_null(np.iinfo(np.int64).max)) if whole else np.zeros(batch.num_rows, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column, weights = queries.lookup()
        best: pa.Table | None = None
        for batch in batches:
            ids, found = ids_of(batch), []
            for start, bounds in _bounds(batch, queries, column, weights):
                own = ids[start : start + bounds.shape[0]]
                may = (bounds > least) | ((bounds == least) & (own[:, None] <= last))
                if floors is None:
                    may &= _largest(bounds, own, k)
                row, item = np.nonzero(may)
                found.append((row + start, item, bounds[row, item]))
            rows, items, bound = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
            out = pa.table({"item": pa.array(items, pa.int32()), "doc_id": batch.column("doc_id").take(pa.array(rows)), "key": batch.column("key").take(pa.array(rows)),
                            "bound": pa.array(bound.astype(np.int64)), "order": pa.array(ids[rows])})
            if floors is not None:
                yield from out.drop_columns("order").to_batches()
                continue
            out = out if best is None else pa.concat_tables([best, out])
            order = np.lexsort((out["order"].to_numpy(), -out["bound"].to_numpy(), out["item"].to_numpy()))
            out = out.take(pa.array(order))
            item = out["item"].to_numpy()
            place = np.arange(item.size) - np.searchsorted(item, item)
            best = out.filter(pa.array(place < k))
        if best is not None:
            yield from best.drop_columns("order").combine_chunks().to_batches()

    kind = index.schema["doc_id"].dataType.simpleString()
    return index.mapInArrow(run, f"item int, doc_id {kind}, key long, bound long")


def _largest(bounds: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Where the ``k`` largest of each column are, of equal ones those of smaller ids."""
    if bounds.shape[0] <= k:
        return np.ones(bounds.shape, dtype=bool)
    by_id = np.argsort(ids, kind="stable")
    order = by_id[np.argsort(-bounds[by_id], axis=0, kind="stable")[:k]]
    mask = np.zeros(bounds.shape, dtype=bool)
    np.put_along_axis(mask, order, True, axis=0)
    return mask


def _rescored(docs: DataFrame, asked: DataFrame, queries: Queries) -> DataFrame:
    """Exact scores above 0 of the documents ``asked`` for: ``item, doc_id, score``. Their texts
    are read again and their terms compared as they are. The few that are asked for, which is
    counted, go to the texts; only where they are many are texts shuffled to meet them."""
    asked = kept(asked.select("item", "doc_id", "key"), "asked")
    wanted = asked.groupBy("doc_id", "key").agg(F.collect_set("item").alias("items"))
    if asked.count() <= SENT:
        wanted = F.broadcast(wanted)
    same = docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["key"] == wanted["key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, items, scores = [], [], []
            for row, (value, own) in enumerate(zip(batch.column(1), batch.column(2))):
                tf = counted(value.as_py())
                m = damping(tf.total(), queries.documents, queries.total)
                for item in own.as_py():
                    score = sum(times * queries.weights[term] * impact(tf[term], m) for term, times in queries.terms[item].items() if term in tf)
                    if score > 0:
                        rows.append(row)
                        items.append(item)
                        scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int32()), batch.column(0).take(pa.array(rows, pa.int64())), pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    joined = docs.join(wanted, same).select(docs["doc_id"], "body", "items")
    return joined.mapInArrow(run, f"item int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _asked(items: DataFrame, block: int, blocks: int) -> tuple[list, list[dict[bytes, int]]]:
    """Ids and term counts of the items of a block."""
    found: dict = defaultdict(Counter)
    for row in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect():
        found[row["item_id"]] += counted(bytes(row["body"]))
    ids = [item for item, own in found.items() if own]
    return ids, [dict(found[item]) for item in ids]


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` best documents of every item: ``item_id, rank, doc_id, score``, scores above 0,
    the highest first, ties by ascending ``doc_id`` and NULL ids last.

    All documents count and are ranked. Items go in blocks of about ``ITEMS``. For each block the
    index is scanned twice and bounds every document for every item. The ``k`` documents of the
    largest bounds are scored exactly first; their ``k``-th best score is a floor, and from then
    on only documents whose bound reaches it, by descending bound the ones before the threshold,
    are read and scored. Bounds never lie below scores, so none is missed. What a task sends is
    ``k`` rows an item at first, then the survivors; texts of the others are never read again.

    NULL and empty texts have no terms. Rows with one document id are documents of their own,
    rows with one item id are one item with the terms of all. Items without a term, or an empty
    table on either side, give no rows. Other columns take no part, whatever their names. Texts
    are read in pieces, so long ones need memory for their distinct terms only."""
    return settled(docs.sparkSession, "ranked", lambda: _search(_Table(docs, doc_id, text), _Table(items, item_id, item_text), k))


@dataclass(frozen=True)
class _Table:
    rows: DataFrame
    id: str
    text: str


def _search(docs: _Table, items: _Table, k: int) -> DataFrame:
    spark = docs.rows.sparkSession
    kind, item_kind = docs.rows.schema[docs.id].dataType, items.rows.schema[items.id].dataType
    asked = cut(items.rows, item_id=items.id, text=items.text).where(F.col("text").isNotNull())
    asked = asked.select("item_id", F.col("text").cast("binary").alias("body"))
    blocks = math.ceil(asked.count() / ITEMS)
    bodies = _keyed(docs.rows, docs.id, docs.text)
    whole = spark.createDataFrame([], StructType([
        StructField("item_id", item_kind), StructField("rank", IntegerType()), StructField("doc_id", kind), StructField("score", LongType())]))
    index = kept(build(docs.rows, docs.id, docs.text), "sketches") if blocks else None
    for block in range(blocks):
        ids, own = _asked(asked, block, blocks)
        if not ids:
            continue
        filled, total, _, holding = frequencies(docs.rows, {term for one in own for term in one}, docs.text)
        queries = Queries(ids, own, {term: weight(filled, n) for term, n in holding.items()}, filled, total)
        order = Window.partitionBy("item").orderBy(F.desc("bound"), F.asc_nulls_last("doc_id"))
        first = _bounded(index, queries, k, None).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
        floors = [(0, None)] * len(ids)
        for row in _ranked(_rescored(bodies, first, queries), k).where(F.col("rank") == k).collect():
            floors[row["item"]] = (row["score"], row["doc_id"])
        found = _ranked(_rescored(bodies, _bounded(index, queries, k, floors), queries), k)
        named = spark.createDataFrame(list(enumerate(ids)), StructType([StructField("item", IntegerType()), StructField("item_id", item_kind)]))
        found = found.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")
        whole = whole.union(found if blocks == 1 else kept(found, "ranked-items"))
    return whole
