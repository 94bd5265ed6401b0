"""Nearest neighbours by inner product: a vantage-point tree for each shard of the vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from tidemark.llm.frames import cut, kept

#: Vectors of a shard, queries of a block, and vectors below which a tree is not split.
SHARD, BLOCK, LEAF = 4096, 512, 128
#: Blocks that are searched in one tree.
BLOCKS = 4


def _finite(vector: Column) -> Column:
    """Neither NULL nor zero, and every component finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


class Tree:
    """A vantage-point tree over points of one shard.

    Inner products become distances by one more component: with ``reach`` the length of the
    longest vector of all shards, ``sqrt(reach**2 - |x|**2)`` is added to a vector and 0 to a
    query. Then the nearest point has the largest inner product."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, reach: float, rows: np.ndarray | None = None) -> None:
        rest = np.sqrt(np.maximum(reach**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        self.rows = ids if rows is None else rows
        self.ids, self.vectors, self.points = ids, vectors, np.column_stack([vectors, rest])
        self.root = self._split(np.arange(ids.size))

    def _split(self, rows: np.ndarray):
        if rows.size <= LEAF:
            return rows
        # The point farthest from the first one sees the others at the most varied distances.
        vantage = rows[np.argmax(self._distances(self.points[rows[0]], rows))]
        away = self._distances(self.points[vantage], rows)
        order = np.argsort(away, kind="stable")
        half = rows.size // 2
        near, far = rows[order[:half]], rows[order[half:]]
        return vantage, away[order[half - 1]], away[order[half]], self._split(near), self._split(far)

    def _distances(self, point: np.ndarray, rows: np.ndarray) -> np.ndarray:
        gap = self.points[rows] - point
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def search(self, query_rows: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the ``k`` points found for each query, and their inner products, the largest
        first; -1 where there are fewer. Ids settle ties, and a query does not find its own row.

        Every query goes down to its own leaf first, which bounds how far its neighbours are.
        Then the tree is searched by all queries at once, each leaving out the branches that its
        bound and the triangle inequality rule out. ``factor`` multiplies the bound: one keeps
        the search exact, less prunes more and may miss some."""
        count = queries.shape[0]
        best = np.full((count, k), -np.inf)
        rows = np.full((count, k), -1)
        points = np.column_stack([queries, np.zeros(count)])
        length = np.einsum("ij,ij->i", queries, queries)
        slack = 1e-9 * (1 + np.sqrt(length) * np.sqrt(np.einsum("ij,ij->i", self.points, self.points).max(initial=0)))
        square = float(np.einsum("j,j->", self.points[0], self.points[0])) if self.ids.size else 0.0

        def visit(node, who: np.ndarray, bound: bool) -> None:
            if not isinstance(node, tuple):
                # Products by matrix rule out most; those that may count are added up in order.
                rough = queries[who] @ self.vectors[node].T
                may = rough >= (best[who, -1] - slack[who])[:, None]
                some = may.any(axis=1)
                who, may = who[some], may[some]
                if not who.size:
                    return
                left, right = np.nonzero(may)
                scores = np.full(may.shape, -np.inf)
                scores[left, right] = _products(queries[who[left]], self.vectors[node[right]])
                scores[query_rows[who][:, None] == self.rows[node][None, :]] = -np.inf
                every = np.concatenate([best[who], scores], axis=1)
                named = np.concatenate([rows[who], np.broadcast_to(node, scores.shape)], axis=1)
                numbers = np.where(named >= 0, self.ids[named], np.iinfo(np.int64).max)
                order = np.lexsort((numbers, -every), axis=1)[:, :k]
                best[who], rows[who] = np.take_along_axis(every, order, 1), np.take_along_axis(named, order, 1)
                rows[who] = np.where(np.isneginf(best[who]), -1, rows[who])
                return
            vantage, inner, outer, near, far = node
            gap = points[who] - self.points[vantage]
            away = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            nearer = away <= (inner + outer) / 2
            if bound:
                for child, own in ((near, nearer), (far, ~nearer)):
                    if own.any():
                        visit(child, who[own], True)
                return
            for first in (True, False):  # the nearer branch first, then what is left of the other
                for child, own, least in ((near, nearer, away - inner), (far, ~nearer, outer - away)):
                    turn = own if first else ~own
                    radius = np.sqrt(np.maximum(length[who] + square - 2 * best[who, -1], 0)) * factor
                    go = turn & (least <= radius * (1 + 1e-9) + 1e-12)
                    if go.any():
                        visit(child, who[go], False)

        if self.ids.size:
            everyone = np.arange(count)
            if isinstance(self.root, tuple):
                visit(self.root, everyone, True)
                seeded = best[:, -1].copy()
                best[:], rows[:] = -np.inf, -1
                best[:, -1] = np.where(np.isneginf(seeded), -np.inf, np.nextafter(seeded, -np.inf))
            visit(self.root, everyone, False)
        return rows, best


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row in double precision, added up from the first component on."""
    return np.cumsum(left * right, axis=1)[:, -1] if left.shape[1] else np.zeros(left.shape[0])


_PACKED = StructType([StructField("group", IntegerType()), *(StructField(n, BinaryType()) for n in ("rows", "ids", "vectors"))])


def _packed(df: DataFrame, groups: int, name: str) -> DataFrame:
    """Vectors of a group as one row: its number, the numbers of its rows, ids, and vectors as
    doubles. Rows are dealt by their numbers, so neither ids nor equal vectors make a group large."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows, ids = (table[c].to_numpy().astype(np.int64) for c in ("row", "vec_id"))
        order = np.lexsort((rows, ids))
        values = np.asarray(table["vector"].combine_chunks().flatten().cast(pa.float64())).reshape(ids.size, -1)[order]
        packed = (rows[order].tobytes(), ids[order].tobytes(), values.tobytes())
        return pa.table({"group": pa.array([key[0].as_py()], pa.int32()), **{n: pa.array([v], pa.binary()) for n, v in zip(("rows", "ids", "vectors"), packed)}})

    place = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")
    return df.withColumn("group", place).groupBy("group").applyInArrow(run, _PACKED).withColumnRenamed("group", name)


_FOUND = StructType([StructField("query", LongType()), StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType())])


def _arrays(table: pa.Table, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for row in table.select(["rows", "ids", "vectors"]).to_pylist():
        yield np.frombuffer(row["rows"], np.int64), np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"]).reshape(-1, width)


def _searched(every: DataFrame, asked: DataFrame, rows: int, questions: int, width: int, reach: float, k: int, factor: float) -> DataFrame:
    """The ``k`` nearest that each shard has for each query, of vectors of one length."""
    shards, blocks = max(1, math.ceil(rows / SHARD)), max(1, math.ceil(questions / BLOCK))
    shard = kept(_packed(every, shards, "shard"), "shards")
    block = kept(_packed(asked, blocks, "block"), "blocks")
    # Every block meets every shard, which is the search itself. Blocks travel, as they are the
    # smaller ones; a shard is copied once for some of them, which share its tree.
    left = shard.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // BLOCKS))))
    right = block.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("part", F.floor(F.col("block") / BLOCKS).cast("int"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        for numbers, ids, vectors in _arrays(left, width):
            tree = Tree(ids, vectors, reach, numbers)
            for queries, query_ids, asked in _arrays(right, width):
                hits, _ = tree.search(queries, asked, k, factor)
                own, rank = np.nonzero(hits >= 0)
                hits = hits[own, rank]
                found.append((queries[own], query_ids[own], tree.ids[hits], _products(asked[own], tree.vectors[hits])))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return pa.table([pa.array(c) for c in columns], names=_FOUND.names)

    return left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInArrow(run, _FOUND)


def nearest(vectors: DataFrame, queries: Column, k: int, factor: float = 1.0, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` nearest by inner product of every vector that ``queries`` holds for, among all
    other rows: ``query_id, rank, vec_id, score``, ties to the smaller id.

    Vectors are numbered and dealt by their numbers to shards of about ``SHARD``, queries to blocks
    of about ``BLOCK``; a task builds a shard's tree and searches some blocks in it. Each pair of
    them yields ``k`` rows a query at most, ranked once more over all shards. Nothing is gathered
    beyond a shard and some blocks. With ``factor=1`` results are exact.

    NULL ids, and vectors that are NULL, empty, zero or hold NULL or non-finite components, take no
    part. Every other row is a query and a candidate of its own, whatever ids and vectors repeat: it
    does not find itself, but others of its id. Vectors meet those of their own length, as there is
    no product with others. An empty table gives no rows; other columns are left behind."""
    every = cut(vectors.withColumn("asked here", F.coalesce(queries, F.lit(False))), vec_id=vec_id, vector=embedding, asked="asked here")
    every = every.withColumn("vector", F.col("vector").cast("array<double>")).where(F.col("vec_id").isNotNull() & _finite(F.col("vector")))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    every = kept(every.withColumn("row", F.monotonically_increasing_id()).withColumn("width", F.size("vector")), "vectors")
    sizes = every.groupBy("width").agg(F.count(F.lit(1)).alias("rows"), F.count_if("asked").alias("asked"), F.max(norm).alias("reach")).collect()
    found = every.sparkSession.createDataFrame([], _FOUND)
    for size in sorted(sizes):
        own = every.where(F.col("width") == size["width"])
        found = found.union(_searched(own, own.where("asked"), size["rows"], size["asked"], size["width"], size["reach"], k, factor))
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
