"""Substring deduplication by a sorted array of suffixes, dealt out by ranges of their tokens."""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.frames import cut, parts, text_bytes
from tidemark.llm.runs import (ASKED, COVERED, SCHEMA, WINDOWS, Texts, by_text, byte_units,
                               covered_rows, find_runs, grouped, passed_on, table_of,
                                with_texts)
from tidemark.llm.texts import BYTE_VALUES, CHUNK, Hashes, pack, sliding_min, unpack_all

#: Bytes of a string that counts, of the grams that mark windows, of the anchors that deal
#: suffixes, and of a token of a suffix.
WIDTH, GRAM, ANCHOR, TOKEN = 50, 20, 32, 8
#: Bytes of text for a bucket, and suffixes for a bucket.
BUCKET_BYTES, BUCKET_SUFFIXES = 8 << 20, 1 << 20
#: Arrays of stretches of suffixes: doc_id, tag, first suffix, suffixes, place of the anchor in the
#: first one, bytes.
STRETCHES = ("i8", "u4", "u4", "u1", "u1", "u1")
#: Bits of a key that hold the place of an anchor.
_PLACE = np.uint64((1 << 20) - 1)
#: Documents that splitters are sampled from, and suffixes of each. They balance the buckets and
#: have no influence on results.
SAMPLED, EACH = 4000, 8


def tokens_of(suffixes: np.ndarray) -> np.ndarray:
    """Suffixes, one in a row of bytes, as rows of big-endian 8-byte tokens: they sort alike."""
    count, width = suffixes.shape
    padded = np.zeros((count, -(-width // TOKEN) * TOKEN), dtype=np.uint8)
    padded[:, :width] = suffixes
    return padded.view(">u8").astype(np.uint64)


def sort_suffixes(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort: the order of the rows, and which of them, in that order, differ from
    the one before.

    Sorts by the first token; every stretch of equal tokens is then sorted by the next one, and
    so on. A suffix is looked at no deeper than it takes to tell it from its neighbours. The
    stretches of one depth are sorted together, as they are apart already."""
    count, depth = tokens.shape
    order = np.argsort(tokens[:, 0], kind="stable")
    first = tokens[order, 0]
    new = np.r_[True, first[1:] != first[:-1]][:count]
    for level in range(1, depth):
        tied = ~new
        tied[:-1] |= ~new[1:]
        where = np.flatnonzero(tied)
        if not where.size:
            break
        stretch = np.cumsum(new[where])
        key = tokens[order[where], level]
        own = np.lexsort((key, stretch))
        order[where] = order[where][own]
        key = key[own]
        new[where] |= np.r_[True, key[1:] != key[:-1]]
    return order, new


def _smallest(order: np.ndarray, new: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each suffix in sorted order the smallest document that has an equal one."""
    starts = np.flatnonzero(new)
    return np.repeat(np.minimum.reduceat(ids[order], starts), np.diff(np.r_[starts, new.size])) if starts.size else ids[:0]


def _splitters(docs: DataFrame, rows: int, buckets: int) -> list[bytes]:
    """Anchors that cut a sample of all grams of their size into parts of equal size."""
    if buckets < 2 or not rows:
        return []
    every = max(1, rows // SAMPLED)
    body = F.encode("text", "UTF-8")
    size = F.octet_length("text")
    at = F.sequence(F.lit(0), F.lit(EACH - 1))
    picked = docs.where((F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0) & (size >= WIDTH)).select(
        F.explode(F.transform(at, lambda i: F.substring(body, (F.xxhash64("doc_id", i) % (size - WIDTH + 1) + size - WIDTH + 1) % (size - WIDTH + 1) + 1, F.lit(ANCHOR)))).alias("anchor"))
    sample = sorted(bytes(row["anchor"]) for row in picked.collect())
    return sorted({sample[len(sample) * i // buckets] for i in range(1, buckets)}) if sample else []


def _within(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of stretches, one stretch after the other."""
    return np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _anchors(data: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Where the anchor of each suffix begins, counted from the suffix: the leftmost of its grams of
    ``ANCHOR`` bytes whose hash is least. Only the suffix's own bytes decide on it, so equal
    suffixes have one anchor at one place; neighbours in a text mostly share theirs. The hash
    only chooses, nothing is held equal by it. Suffixes that follow each other in the text are
    hashed together, about ``CHUNK`` bytes at a time."""
    out = np.zeros(where.size, dtype=np.int64)
    starts = np.flatnonzero(np.r_[True, where[1:] != where[:-1] + 1][: where.size])
    counts = np.diff(np.r_[starts, where.size])
    sizes = counts + WIDTH - 1
    chunk = (np.cumsum(sizes) - sizes) // CHUNK
    cuts = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1], True]) if starts.size else [0]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        begin = np.cumsum(sizes[a:b]) - sizes[a:b]
        grams = Hashes(BYTE_VALUES[data[_within(where[starts[a:b]], sizes[a:b])]]).all_of(ANCHOR)
        least = sliding_min(grams & ~_PLACE | np.arange(grams.size, dtype=np.uint64), WIDTH - ANCHOR + 1) & _PLACE
        own = _within(begin, counts[a:b])
        out[starts[a] : starts[a] + own.size] = least[own].astype(np.int64) - own
    return out


def _suffix_rows(texts: Texts, rows: pa.Table, splitters: list[bytes], doc_buckets: int) -> pa.Table:
    """Suffixes of the runs that are asked for: those of one anchor as a stretch of bytes, sorted
    by their anchors and cut at the splitters."""
    out = []
    named = list(by_text([row[3] for row in passed_on(rows, ASKED)], ASKED))
    if not named:
        return table_of(out)
    found = texts.rows_of(np.array([n[0] for n, _ in named]), np.array([n[1] for n, _ in named]))
    where, ids, tags, first = [], [], [], []
    for name, (_, _, begin, sizes, *_) in named:
        for row in found.get(name, [])[:1]:  # rows of one name have one text
            own = np.unique(_within(begin.astype(np.int64), sizes.astype(np.int64)))
            where.append(own + texts.bounds[row])
            first.append(own)
            ids.append(np.full(own.size, name[0]))
            tags.append(np.full(own.size, name[1], dtype=np.uint32))
    if not where:
        return table_of(out)
    where, ids, tags, first = (np.concatenate(x) for x in (where, ids, tags, first))
    view = np.lib.stride_tricks.sliding_window_view(texts.data, WIDTH)
    step = 1 << 18
    for low in range(0, where.size, step):
        part = slice(low, low + step)
        order, new = sort_suffixes(tokens_of(view[where[part]]))
        own_where, own_ids, own_tags, own_first = where[part], ids[part], tags[part], first[part]
        later = own_ids[order] > _smallest(order, new, own_ids)
        copies, stay = order[later], np.sort(order[~later])
        out += covered_rows(own_ids[copies], own_tags[copies], own_first[copies], own_first[copies], doc_buckets)
        own_where, own_ids, own_tags, own_first = (x[stay] for x in (own_where, own_ids, own_tags, own_first))
        out += _stretch_rows(texts.data, own_where, own_ids, own_tags, own_first, splitters)
    return table_of(out)


def _stretch_rows(data: np.ndarray, where: np.ndarray, ids: np.ndarray, tags: np.ndarray, first: np.ndarray, splitters: list[bytes]) -> Iterator[tuple]:
    """Neighbouring suffixes that share their anchor as one stretch of bytes, for the bucket of the
    anchor: a row for each bucket."""
    if not where.size:
        return
    lead = _anchors(data, where)
    # Neighbours share an anchor where it is one place nearer to the next suffix.
    starts = np.flatnonzero(np.r_[True, (where[1:] != where[:-1] + 1) | (lead[1:] != lead[:-1] - 1)])
    counts = np.diff(np.r_[starts, where.size])
    anchors = np.lib.stride_tricks.sliding_window_view(data, ANCHOR)[(where + lead)[starts]]
    order, _ = sort_suffixes(tokens_of(anchors))
    anchors, starts, counts = anchors[order], starts[order], counts[order]
    cuts = [0, *(_first_not_below(anchors, s) for s in splitters), starts.size]
    for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if b > a:
            own, sizes = starts[a:b], counts[a:b]
            yield WINDOWS, bucket, int(sizes.sum()), pack(ids[own], tags[own], first[own].astype(np.uint32), sizes.astype(np.uint8),
                                                          lead[own].astype(np.uint8), data[_within(where[own], sizes + WIDTH - 1)])


def _first_not_below(sorted_anchors: np.ndarray, splitter: bytes) -> int:
    class Rows:
        def __len__(self) -> int:
            return sorted_anchors.shape[0]

        def __getitem__(self, i: int) -> bytes:
            return sorted_anchors[i].tobytes()

    return bisect_left(Rows(), splitter)


def _sort_bucket(doc_buckets: int):
    """Sort a range of suffixes; those that an earlier document has too are covered. Splitters are
    whole anchors and an anchor equal to one goes to the right of it, so equal suffixes, which
    have equal anchors at equal places, never lie on both sides of a boundary: comparing there is
    done by how they are dealt. Suffixes are laid out and sorted for one place of the anchor at a
    time, so no more than one of a stretch at once."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() != WINDOWS:
            return table
        ids, tags, first, counts, lead, data = unpack_all(table["data"].to_pylist(), STRETCHES)
        counts, lead = counts.astype(np.int64), lead.astype(np.int64)
        begin = np.cumsum(counts + WIDTH - 1) - (counts + WIDTH - 1)
        view = np.lib.stride_tricks.sliding_window_view(data, WIDTH)
        found = [(np.zeros(0, np.int64),) * 2]
        for place in range(WIDTH - ANCHOR + 1):
            rows = np.flatnonzero((place <= lead) & (place > lead - counts))
            skip = lead[rows] - place
            order, new = sort_suffixes(tokens_of(view[begin[rows] + skip]))
            later = order[ids[rows[order]] > _smallest(order, new, ids[rows])]
            found.append((rows[later], skip[later]))
        rows, skip = (np.concatenate(x) for x in zip(*found, strict=True))
        at = first[rows].astype(np.int64) + skip
        return table_of(list(covered_rows(ids[rows], tags[rows], at, at, doc_buckets)))

    return run


def _left(texts: Texts, rows: pa.Table, with_text: bool, names: list[str]) -> pa.Table:
    """What is left of each text of a bucket."""
    covered = dict(by_text(rows["data"].to_pylist(), COVERED))
    found = texts.rows_of(np.array([n[0] for n in covered], dtype=np.int64), np.array([n[1] for n in covered], dtype=np.int64))
    stretches = {row: covered[name] for name, own in found.items() for row in own}
    removed, spans, digests, bodies = [], [], [], []
    for row in range(texts.ids.size):
        body = texts.data[texts.bounds[row] : texts.bounds[row + 1]]
        if row in stretches:
            _, _, begin, end = stretches[row]
            edge = np.zeros(body.size + 1, dtype=np.int32)
            np.add.at(edge, begin.astype(np.int64), 1)
            np.add.at(edge, end.astype(np.int64) + WIDTH, -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1])))
            body = body[~gone]
        else:
            removed.append(0)
            spans.append(0)
        digests.append(hashlib.sha256(memoryview(body)).hexdigest())
        if with_text:
            bodies.append(body.tobytes().decode("utf-8", "ignore"))
    ids = pa.array(texts.ids, mask=~texts.known)
    columns = [ids, pa.array(np.diff(texts.bounds)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
    if with_text:
        columns += [pa.array([zlib.crc32(texts.bytes_of(i)) for i in range(texts.ids.size)], pa.int64()), pa.array(bodies, pa.string())]
    return pa.table(columns, names=names)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """Remove from each text the bytes that a 50-byte string covers which also starts in a
    document of a smaller id. Texts are taken whole, as UTF-8 bytes, and judged as they came.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` a row for a row, and with
    ``with_text`` also ``crc`` of the original and the text left, ``body``, without characters
    that were cut in two. NULL and empty texts
    have no bytes; rows with a NULL id take no part and lose nothing; rows of one id are one
    document, which loses nothing to itself.

    First, runs of windows that are equal as a whole in an earlier document are found by their
    hashes (see :mod:`tidemark.llm.runs`). Where runs agree only in part, at the ends of
    passages and in chance matches, their suffixes are sorted: sampled splitters range-partition
    them by the tokens of their anchors, every bucket is sorted by multikey quicksort, and equal
    neighbours are compared by document. A string that many documents share leaves each batch
    once, and neighbouring suffixes of one anchor travel as the stretch of text they cover."""
    docs = cut(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows, size = text_bytes(docs)
    buckets = parts(size, BUCKET_BYTES)
    found = find_runs(docs, byte_units, WIDTH, GRAM, buckets, buckets)
    suffixes = found.where(F.col("kind") == ASKED).agg(F.sum("weight")).first()[0] or 0
    splitters = _splitters(docs, rows, parts(suffixes * 16, BUCKET_SUFFIXES))
    asked, settled = found.where(F.col("kind") == ASKED), found.where(F.col("kind") == COVERED)
    dealt = with_texts(docs, asked, buckets, lambda texts, own: _suffix_rows(texts, own, splitters, buckets), SCHEMA)
    covered = settled.union(grouped(dealt, _sort_bucket(buckets), "suffixes"))
    fields = [StructField("doc_id", LongType()), *(StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")), StructField("kept_sha256", StringType())]
    if with_text:
        fields += [StructField("crc", LongType()), StructField("body", StringType())]
    names = [field.name for field in fields]
    return with_texts(docs, covered, buckets, lambda texts, own: _left(texts, own, with_text, names), StructType(fields))
