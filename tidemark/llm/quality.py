"""Quality classifier: averaged vectors of hashed words and character n-grams, softmax output."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from tidemark.llm.frames import cut
from tidemark.llm.labelled import sample
from tidemark.llm.texts import BYTE_VALUES, WHITE, Batch, Hashes, mix, pack, sliced, unpack, word_values, words


@dataclass(frozen=True)
class Settings:
    """What a model is and how it learns. ``bound`` is the most labelled texts it learns from,
    ``size`` the most bytes of these."""

    bound: int = 8000
    size: int = 1 << 27
    buckets: int = 1 << 18
    grams: tuple[int, ...] = (3, 4, 5)
    dim: int = 8
    epochs: int = 6
    rate: float = 40.0
    seed: int = 7


#: White space of any kind stands as one mark at either end of a word.
_MARKED = np.arange(256, dtype=np.uint8)
_MARKED[WHITE] = 0x20


def features(batch: Batch, start: int, end: int, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the features of the texts from ``start`` to before ``end``, each with the
    number of the text it is in: every word, whether it repeats the word before it, and every
    n-gram of characters of a word and the marks at its ends. Texts are taken whole."""
    bounds = batch.bounds[start : end + 1]
    count = end - start
    data = np.full(int(bounds[-1] - bounds[0]) + count + 1, 0x20, dtype=np.uint8)
    owner = np.repeat(np.arange(count), np.diff(bounds))
    data[np.arange(owner.size) + 1 + owner] = _MARKED[batch.data[bounds[0] : bounds[-1]]]
    edges = bounds - bounds[0] + np.arange(count + 1)
    top = np.uint64(64 - (settings.buckets.bit_length() - 1))
    starts, ends, before = words(data, np.r_[0, edges[1:]])
    values = word_values(data, starts, ends)
    inside = np.repeat(np.arange(count), np.diff(before))
    yield (mix(values + np.uint64(1)) >> top).astype(np.int64), inside
    again = np.zeros(values.size, dtype=np.uint64)
    again[1:] = (values[1:] == values[:-1]) & (inside[1:] == inside[:-1])
    yield (mix(again + np.uint64(2)) >> top).astype(np.int64), inside
    hashes = Hashes(BYTE_VALUES[data])
    # Where characters begin, and the number of marks before each of them.
    first = np.flatnonzero((data & 0xC0) != 0x80)
    after = np.r_[first, data.size]
    blanks = np.r_[0, np.cumsum(data[first] == 0x20)]
    for n in settings.grams:
        if first.size < n:
            continue
        # A gram has marks at its ends only.
        own = np.flatnonzero(blanks[n - 1 : first.size] == blanks[1 : first.size - n + 2])
        at, end = first[own], after[own + n]
        values = hashes.raw(at, end) * np.uint64(0x9E3779B97F4A7C15)
        yield (values >> top).astype(np.int64), np.searchsorted(edges, at, side="right") - 1


def _examples(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, label`` and the features of each text, with how much each counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches):
            batch, packed = Batch(rows.column(1)), []
            for i in range(len(batch)):
                found = np.concatenate([f for f, _ in features(batch, i, i + 1, settings)])
                ids, counts = np.unique(found, return_counts=True)
                packed.append(pack(ids.astype(np.uint32), (counts / max(found.size, 1)).astype(np.float32)))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).cast(pa.int64()), rows.column(2).cast(pa.int32()), pa.array(packed, pa.binary())], ["doc_id", "label", "data"])

    schema = StructType([StructField("doc_id", LongType()), StructField("label", IntegerType()), StructField("data", BinaryType())])
    return docs.mapInArrow(run, schema)


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent over (label, features, weights), in one seeded order.

    Returns what each bucket adds to the log-odds of label 1 where it is the whole text, and the
    log-odds of an empty text. The softmax over two classes depends on no more than that."""
    random = np.random.default_rng(settings.seed)
    dim = settings.dim
    vectors = random.uniform(-1 / dim, 1 / dim, (settings.buckets, dim)).astype(np.float32)
    out, bias = np.zeros((dim, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, done = max(1, settings.epochs * len(examples)), 0
    for _ in range(settings.epochs):
        for i in random.permutation(len(examples)):
            label, ids, weights = examples[i]
            rate = settings.rate * (1 - done / steps)
            done += 1
            own = vectors[ids]
            mean = weights @ own
            logits = mean @ out + bias
            chances = np.exp(logits - logits.max())
            chances /= chances.sum()
            chances[label] -= 1
            back = out @ chances
            out -= min(rate, 0.5) * np.outer(mean, chances)
            bias -= np.float32(min(rate, 0.05)) * chances
            vectors[ids] = own - np.float32(rate) * weights[:, None] * back
    return (vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column, settings: Settings = Settings()) -> tuple[np.ndarray, float]:
    """A model from at most ``settings.bound`` labelled texts that ``learn`` holds for.

    Features are found where the texts are; one task learns from them, as their number is
    bounded, and only the model, ``buckets`` floats, comes to the driver. Without any example
    every score is one half."""
    examples = _examples(sample(docs, labels, label, learn, settings.bound, settings.size), settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns), strict=True)]
        rows.sort(key=lambda row: row[:2])
        table, bias = train([(row[1], *unpack(row[2])) for row in rows], settings)
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary()), pa.array([bias], pa.float64())], ["data", "bias"])

    schema = StructType([StructField("data", BinaryType()), StructField("bias", DoubleType())])
    model = examples.repartition(1).mapInArrow(run, schema).first()
    return np.frombuffer(bytes(model["data"]), dtype=np.float32), model["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], settings: Settings = Settings()) -> DataFrame:
    """``doc_id`` and the ``score``, from 0 to 1, of each whole text, a row for a row. Texts that
    are empty or NULL get the model's score of no evidence. One pass, no shuffle; ids may be
    NULL or repeated, and other columns are left behind."""
    table, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for rows in sliced(batches):
            batch = Batch(rows.column(1))
            scores = np.empty(len(batch))
            for start, end in batch.chunks():
                total, number = np.zeros(end - start), np.zeros(end - start)
                for found, owner in features(batch, start, end, settings):
                    total += np.bincount(owner, weights[found], end - start)
                    number += np.bincount(owner, minlength=end - start)
                scores[start:end] = 1 / (1 + np.exp(-(total / np.maximum(number, 1) + bias)))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(scores)], ["doc_id", "score"])

    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("score", DoubleType())])
    return cut(docs, doc_id="doc_id", text="text").mapInArrow(run, schema)
