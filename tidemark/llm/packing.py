"""Best-fit packing of token sequences, in supersteps over classes of equal size."""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.frames import cut, kept, parts
from tidemark.llm.tokens import encode_text

#: Rows that one task ranks.
ROWS = 100_000


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary: itself where it is printable,
    else the next free one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def added(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """The tokens that a ``tokenizers`` file adds to its model, special ones among them: the
    library takes them out of a text, the leftmost and of these the longest first, before the
    model sees what is between. A pattern that finds them (None for none), and their ids."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens") or []
    if any(token.get(flag) for token in tokens for flag in ("lstrip", "rstrip", "single_word")):
        raise ValueError(f"{path}: added tokens that take in their surroundings are not supported")
    ids = {token["content"]: token["id"] for token in tokens if token["content"]}
    longest = sorted(ids, key=len, reverse=True)
    return (re.compile("|".join(map(re.escape, longest))) if longest else None), ids


def ids_of(text: str, path: str, pattern: str) -> list[int]:
    """Ids of a whole text, as the library's ``encode`` gives them without special tokens around."""
    own, (special, numbers) = codec(path, pattern), added(path)
    if special is None:
        return encode_text(own, text)
    ids, at = [], 0
    for found in special.finditer(text):
        ids += encode_text(own, text[at : found.start()])
        ids.append(numbers[found[0]])
        at = found.end()
    return ids + encode_text(own, text[at:]) if at else encode_text(own, text)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` file, as ranks: the same ids several times as
    fast. That holds where every merge makes the token of the next id, which is checked."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    characters = _byte_characters()
    vocabulary = {bytes(characters[c] for c in token): i for token, i in model["vocab"].items() if set(token) <= characters.keys()}
    vocabulary = {token: i for token, i in vocabulary.items() if i < 256 + len(model["merges"])}
    pairs = (merge if isinstance(merge, list) else merge.split(" ") for merge in model["merges"])
    made = [model["vocab"]["".join(pair)] for pair in pairs]
    if made != list(range(256, 256 + len(made))):
        raise ValueError(f"{path}: ids are not in the order of the merges")
    return tiktoken.Encoding("merges", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})


def pieces(docs: DataFrame, path: str, pattern: str, capacity: int, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document: its ids and ``end_id``
    after them, cut only where they exceed ``capacity``. The first piece is then the short one,
    so that all others fill a sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out = [], [array("q") for _ in range(4)]
            for first in range(0, batch.num_rows, 256):
                for i, text in enumerate(batch.column(1).slice(first, 256).to_pylist(), first):
                    ids = array("I", ids_of(text or "", path, pattern))
                    ids.append(end_id)
                    if sys.byteorder == "big":
                        ids.byteswap()
                    begin, end = 0, len(ids) % capacity or min(capacity, len(ids))
                    while begin < len(ids):
                        row.append(i)
                        for column, value in zip(out, (out_piece(begin, capacity), begin, end - begin, zlib.crc32(memoryview(ids)[begin:end])), strict=True):
                            column.append(value)
                        begin, end = end, end + capacity
            columns = [batch.column(0).take(pa.array(row, pa.int32())), *(pa.array(np.frombuffer(c, dtype=np.int64) if len(c) else [], pa.int64()) for c in out)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *(StructField(n, LongType()) for n in ("piece", "start", "length", "ids_crc32"))])
    return cut(docs, doc_id="doc_id", text="text").mapInArrow(run, schema)


def out_piece(begin: int, capacity: int) -> int:
    """The number of the piece that begins at a token: all but the first are full."""
    return -(-begin // capacity)


def best_fit(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Where the items of each size go: rows of size, first rank, items, items a sequence,
    first sequence, offset there.

    A superstep takes the items of one size, the largest first, and all gaps in order. Items are
    matched by rank to the smallest gap that holds them, as many to one gap as it holds, since
    what is left of it is the best fit for the next; those without a gap open sequences. Then
    gaps are updated. That is best-fit decreasing, item for item, though sizes are handled as
    runs: its work depends on ``capacity``, not on the number of items."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # free tokens: sequences, as first and number
    order: list[int] = []
    rows, opened = [], 0

    def leave(free: int, first: int, number: int) -> None:
        if free and number:
            if free not in gaps:
                gaps[free] = []
                insort(order, free)
            gaps[free].append((first, number))

    for size in range(capacity, 0, -1):
        rank, left = 0, int(counts[size])
        while left:
            at = bisect_left(order, size)
            if at < len(order):
                free = order[at]
                first, number = gaps[free].pop()
                if not gaps[free]:
                    del gaps[free], order[at]
            else:
                free, first, number = capacity, opened, -(-left // (capacity // size))
                opened += number
            each = free // size
            used = min(number, -(-left // each))
            items = min(left, used * each)
            rows.append((size, rank, items, each, first, capacity - free))
            full, rest = divmod(items, each)
            leave(free - each * size, first, full)
            if rest:
                leave(free - rest * size, first + full, 1)
            leave(free, first + used, number - used)
            rank, left = rank + items, left - items
    return np.array(rows, dtype=np.int64).reshape(-1, 6)


def pack(docs: DataFrame, path: str, pattern: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens, by best fit.

    Returns a row for each piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``. A NULL or empty text is a piece of one token, ``end_id``; NULL ids and repeated
    rows are packed as they come; an empty table gives no rows.

    Pieces are tokenized once and written. They are sorted by size over ranges of size and
    id, so that a size that many have is dealt to many tasks; each task ranks its own. What comes
    to the driver is the number of pieces of each size in each range, at most ``capacity`` more
    than there are ranges; what goes back, the plan of :func:`best_fit` over sizes."""
    spark = docs.sparkSession
    cuts = kept(pieces(docs, path, pattern, capacity, end_id), "pieces")
    names = [*cuts.columns, "part", "rank"]

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            sizes = np.asarray(batch.column(3))
            starts = np.flatnonzero(np.r_[True, sizes[1:] != sizes[:-1]]) if sizes.size else np.zeros(0, np.int64)
            ranks = np.arange(sizes.size) - np.repeat(starts, np.diff(np.r_[starts, sizes.size]))
            for begin, end in zip(starts, np.r_[starts[1:], sizes.size], strict=True):
                before = seen.get(int(sizes[begin]), 0)
                ranks[begin:end] += before
                seen[int(sizes[begin])] = before + int(end - begin)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(sizes.size, part, dtype=np.int64)), pa.array(ranks, pa.int64())], names)

    schema = StructType([*cuts.schema.fields, StructField("part", LongType()), StructField("rank", LongType())])
    keys = ["length", F.xxhash64("doc_id"), "piece"]
    ranges = parts(cuts.count(), ROWS)
    ranked = kept(cuts.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).mapInArrow(rank, schema), "ranked")

    found = ranked.groupBy("part", "length").count().orderBy("length", "part").collect()
    counts, before = np.zeros(capacity + 1, dtype=np.int64), {}
    for row in found:
        before[(row["part"], row["length"])] = int(counts[row["length"]])
        counts[row["length"]] += row["count"]
    shared = spark.sparkContext.broadcast((before, best_fit(counts, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, plan = shared.value
        ordered = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
        keys = ordered[:, 0] << 40 | ordered[:, 1]
        for batch in batches:
            sizes, part, ranks = (np.asarray(batch.column(i)) for i in (3, 5, 6))
            ranks = ranks + np.array([before[pair] for pair in zip(part.tolist(), sizes.tolist(), strict=True)], dtype=np.int64)
            size, first, _, each, sequence, offset = ordered[np.searchsorted(keys, sizes << 40 | ranks, side="right") - 1].T
            within = ranks - first
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence + within // each), pa.array(offset + within % each * size)],
                [*batch.schema.names[:5], "sequence_id", "offset"])

    placed = StructType([*cuts.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.mapInArrow(place, placed)
