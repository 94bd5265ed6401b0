"""Connected components of links, by stars that shrink in rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import kept


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each batch, by union-find, as links of every node to the least of its tree."""
    for batch in batches:
        above: dict[int, int] = {}

        def root(x: int, above: dict[int, int] = above) -> int:
            top = x
            while above.setdefault(top, top) != top:
                top = above[top]
            while above[x] != top:
                above[x], x = top, above[x]
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                above[max(a, b)] = min(a, b)
        pairs = [(x, root(x)) for x in list(above)]
        pairs = np.array([p for p in pairs if p[0] != p[1]], dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of it and all its neighbours."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of these."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, name: str) -> DataFrame:
    """``node, component`` for every node of ``links`` of ``a, b``: the least node it is connected
    with. A hot node's links are added up before they are shuffled, and joined by a join that
    adaptive execution can split. Each round is written, so nothing is computed twice; two
    numbers tell whether it changed anything. Nodes without links are left out."""
    state = kept(links.select("a", "b").mapInArrow(forest, "u long, v long").distinct(), name)
    mark = None
    while True:
        row = state.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("h")).first()
        if (row["n"], row["h"]) == mark or not row["n"]:
            break
        mark = row["n"], row["h"]
        state = kept(_small_star(_large_star(state)), name)
    inner = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return inner.union(state.select("v", "v").distinct())
