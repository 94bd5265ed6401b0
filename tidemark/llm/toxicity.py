"""Toxicity: maximal-scoring segments over log-odds of tokens, calibrated by extreme values."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StructField,
                               StructType)

from tidemark.llm.frames import cut
from tidemark.llm.labelled import sample
from tidemark.llm.texts import BYTE_VALUES, Batch, Hashes, sliced, words


@dataclass(frozen=True)
class Settings:
    """How a model learns. ``bound`` is the most labelled texts it learns from, ``size`` the most
    bytes of these. They bound the tokens it knows, none of which is left out."""

    bound: int = 20000
    size: int = 1 << 28
    #: Weight of the prior against the counts, and standard errors a token must stand out by.
    prior: float = 0.1
    sure: float = 3.0
    #: Log-odds of a token that says nothing, below zero so that segments end.
    drift: float = -0.25
    #: A segment is significant if so many are expected by chance in a clean text at most.
    expected: float = 0.05


@dataclass(frozen=True)
class Model:
    """Hashes of tokens and their log-odds; decay and scale of the highest segment's
    distribution in clean texts; the logistic curve from its evidence to a chance."""

    keys: np.ndarray
    odds: np.ndarray
    decay: float
    scale: float
    slope: float
    shift: float


#: Letters and digits in lower case, and all bytes of other alphabets, make up tokens.
_FOLDED = np.full(256, 0x20, dtype=np.uint8)
for _byte in range(256):
    if _byte >= 0x80 or chr(_byte).isalnum():
        _FOLDED[_byte] = ord(chr(_byte).lower()) if _byte < 0x80 else _byte


#: Lengths in bytes of the stems that count as tokens beside the whole word, so that inflected
#: and compounded forms share their evidence.
STEMS = (4, 5, 6, 7, 8)


def tokens(batch: Batch, start: int, end: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the words of some texts and of their stems, and the number of words before each
    text. A word as short as a stem has its own hash there."""
    bounds = batch.bounds[start : end + 1]
    data = _FOLDED[batch.data[bounds[0] : bounds[-1]]]
    starts, ends, before = words(data, bounds - bounds[0])
    hashes = Hashes(BYTE_VALUES[data])
    whole = hashes.of(starts, ends)
    stems = [np.where(ends - starts > n, hashes.of(starts, np.minimum(starts + n, ends)) ^ np.uint64(n), whole) for n in STEMS]
    return [whole, *stems], before


def _presence(texts: DataFrame) -> DataFrame:
    """In how many toxic and other texts each token is; added up within a batch already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches):
            batch, labels = Batch(rows.column(1)), np.array(rows.column(2).to_pylist(), dtype=bool)
            keys, counts = [], []
            for start, end in batch.chunks():
                found, before = tokens(batch, start, end)
                for i in range(end - start):
                    own = np.unique(np.concatenate([kind[before[i] : before[i + 1]] for kind in found]))
                    keys.append(own)
                    counts.append(np.full(own.size, labels[start + i]))
            every, toxic = np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(counts or [np.zeros(0, bool)])
            distinct, place = np.unique(every, return_inverse=True)
            hits, total = np.bincount(place[toxic], minlength=distinct.size), np.bincount(place, minlength=distinct.size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), pa.array(hits.astype(np.int64)), pa.array((total - hits).astype(np.int64))], ["token", "toxic", "clean"])

    schema = StructType([StructField(name, LongType()) for name in ("token", "toxic", "clean")])
    return texts.mapInArrow(run, schema).groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _lexicon(counts: DataFrame, settings: Settings) -> list:
    """All tokens whose log-odds, under a Dirichlet prior in proportion to the whole corpus, are
    surely above zero. A bounded sample has a bounded number of them."""
    totals = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    toxic, clean = totals["t"] or 0, totals["c"] or 0
    if not toxic or not clean:
        return []
    weight = settings.prior * (toxic + clean)
    prior = (F.col("toxic") + F.col("clean")) * settings.prior
    one, other = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(one / (toxic + weight - one)) - F.log(other / (clean + weight - other))
    scored = counts.select("token", "clean", odds.alias("odds"), (odds / F.sqrt(1 / one + 1 / other)).alias("sure"))
    return scored.where(F.col("sure") >= settings.sure).collect()


def segments(places: list[int], odds: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a text, as start, end and score, in linear time.

    ``places`` are the tokens with ``odds`` above zero; all others score ``drift``. Each such
    token opens a segment; one whose running total is beaten on its left and beats it on its
    right is merged with what lies between."""
    # start, end, total before, total after, and the nearest segment before with a lower total
    # before it (-1 for none). Segments that such a link passes over can never be looked for again.
    found: list[tuple[int, int, float, float, int]] = []
    total, last = 0.0, -1
    for place, value in zip(places, odds, strict=True):
        total += drift * (place - last - 1)
        start, end, left, right = place, place + 1, total, total + value
        total, last = right, place
        lower = len(found) - 1
        while lower >= 0 and found[lower][2] >= left:
            lower = found[lower][4]
        while lower >= 0 and found[lower][3] < right:
            start, left, further = found[lower][0], found[lower][2], found[lower][4]
            del found[lower:]
            lower = further
        found.append((start, end, left, right, lower))
    return [(start, end, right - left) for start, end, left, right, _ in found]


def _evidence(batch: Batch, model: Model, drift: float) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """Number of words and the segments of each text. A word scores as its surest token."""
    known = np.zeros(1 << 16, dtype=bool)
    known[(model.keys >> np.uint64(48)).astype(np.int64)] = True
    for start, end in batch.chunks():
        found, before = tokens(batch, start, end)
        odds = np.zeros(found[0].size)
        for kind in found:
            likely = np.flatnonzero(known[(kind >> np.uint64(48)).astype(np.int64)])
            at = np.searchsorted(model.keys, kind[likely])
            at[at == model.keys.size] = 0
            same = model.keys[at] == kind[likely] if model.keys.size else np.zeros(0, bool)
            odds[likely[same]] = np.maximum(odds[likely[same]], model.odds[at[same]])
        hits = np.flatnonzero(odds)
        cuts = np.searchsorted(hits, before)
        for i in range(end - start):
            own = hits[cuts[i] : cuts[i + 1]]
            count = int(before[i + 1] - before[i])
            yield count, segments((own - before[i]).tolist(), odds[own].tolist(), drift) if own.size else []


def _log_expected(count: int, highest: float, model: Model) -> float:
    """Log of how many segments as high as the highest a clean text of this length has by
    chance. An empty text counts as one token."""
    return math.log(model.scale * max(count, 1)) - model.decay * highest


def _decay(rates: np.ndarray, odds: np.ndarray, drift: float) -> float:
    """The positive root of E[exp(decay * score)] = 1 for a token of clean text."""
    rest = max(1 - rates.sum(), 0.0)
    if not odds.size or rates @ odds + rest * drift >= 0:
        return 1.0
    low, high = 1e-9, 1.0
    excess = lambda x: rates @ np.exp(np.minimum(x * odds, 600)) + rest * math.exp(x * drift) - 1
    while excess(high) < 0:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through ``y`` over ``x``, by Newton's steps on a
    likelihood with a weak pull to zero."""
    design, weights = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (y - chance) - 1e-2 * weights
        curve = (design * (chance * (1 - chance))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(weights[0]), float(weights[1])


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column, settings: Settings = Settings()) -> Model:
    """A model from at most ``settings.bound`` labelled texts that ``learn`` holds for. Tokens are
    counted by texts, not occurrences, so that one text cannot vouch for its own. The tokens that
    tell, and two numbers for each labelled text, come to the driver; the sample bounds both. Without
    toxic or without clean rows all scores are the share of toxic ones."""
    texts = sample(docs, labels, label, learn, settings.bound, settings.size)
    counts = _presence(texts)
    rows = sorted(_lexicon(counts, settings), key=lambda row: row["token"] & (2**64 - 1))
    keys = np.array([row["token"] for row in rows], dtype=np.int64).view(np.uint64)
    odds = np.array([row["odds"] for row in rows], dtype=np.float64)
    raw = Model(keys, odds, 1.0, 1.0, 0.0, 0.0)
    schema = StructType([StructField("doc_id", LongType()), StructField("label", IntegerType()),
                         StructField("count", LongType()), StructField("highest", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [(count, max((s for _, _, s in own), default=0.0)) for count, own in _evidence(Batch(rows.column(1)), raw, settings.drift)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).cast(pa.int64()), rows.column(2).cast(pa.int32()), pa.array([c for c, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                ["doc_id", "label", "count", "highest"])

    seen = texts.mapInArrow(run, schema).orderBy("doc_id").collect()
    y = np.array([row["label"] for row in seen], dtype=float)
    if not keys.size:
        share = (y.sum() + 0.5) / (y.size + 1) if y.size else 0.0
        return Model(keys, odds, 1.0, 1.0, 0.0, math.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    clean = [row for row in seen if row["label"] == 0]
    length = max(sum(row["count"] for row in clean), 1)
    decay = _decay(np.array([row["clean"] for row in rows]) / length / (1 + len(STEMS)), odds, settings.drift)
    # The scale by moments: as many chance segments as clean texts with any at all.
    scale = max(sum(math.exp(min(decay * row["highest"], 50)) > 1 for row in clean), 1) / length
    model = Model(keys, odds, decay, scale, 0.0, 0.0)
    x = np.array([_log_expected(row["count"], row["highest"], model) for row in seen])
    slope, shift = _logistic(x, y)
    return Model(keys, odds, decay, scale, slope, shift)


def score(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, the ``score`` from 0 to 1 of each whole text, and its significant passages:
    ``segments`` of first word, word after the last, and score. A row for a row, in one pass
    without a shuffle; NULL and empty texts have no passage; ids may be NULL or repeated."""
    return _scored(cut(docs, doc_id="doc_id", text="text"), model, settings, ["doc_id", "score", "segments"])


def accept(docs: DataFrame, model: Model, threshold: float, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``threshold``."""
    hidden = "score of toxicity"
    while hidden in docs.columns:
        hidden += "'"
    scored = _scored(docs, model, settings, [*docs.columns, hidden])
    return scored.where(F.col(f"`{hidden}`") < threshold).drop(hidden)


def _scored(docs: DataFrame, model: Model, settings: Settings, names: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place, with_passages = docs.columns.index("text"), names[-1] == "segments"
    passage = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("score", DoubleType())])
    fields = [field for field in docs.schema.fields if field.name in names]
    carried = [docs.columns.index(field.name) for field in fields]
    more = [StructField(names[len(fields)], DoubleType()), StructField("segments", ArrayType(passage))][: 1 + with_passages]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for rows in sliced(batches, text=place):
            scores, passages = [], []
            for count, own in _evidence(Batch(rows.column(place)), model, settings.drift):
                x = _log_expected(count, max((s for _, _, s in own), default=0.0), model)
                scores.append(1 / (1 + math.exp(-max(min(model.slope * x + model.shift, 700), -700))))
                passages.append([
                    {"start": a, "end": b, "score": s} for a, b, s in own
                    if _log_expected(count, s, model) <= math.log(settings.expected)
                ])
            columns = [rows.column(i) for i in carried] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(passages, kind)] * with_passages, names)

    return docs.mapInArrow(run, StructType([*fields, *more]))
