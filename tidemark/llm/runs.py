"""Windows that recur in other documents, found by runs that contents cut.

A window is ``width`` consecutive units, bytes or words, of one document. Of the hashes of its
k-grams the least one is its mark: equal windows have equal marks, in whatever documents. A run is
a stretch of consecutive windows with one mark; there are few runs, and they travel instead of
windows. The runs of one mark meet in one bucket, where

* equal runs make a class, and all but those of its smallest document are covered;
* marks with one class are done; where there are several, windows may recur in part of a run,
  if what lies on one side of the marking gram agrees. The classes' representatives are asked
  for then, to be compared by their contents.

Equality of runs is by 128 bits of hashes. What is left to compare is small, as copies and
passages are classes up to their ends.

Every batch first finds classes of its own, so that a passage all documents share leaves a batch
once. A mark that many different runs of a batch have, such as that of a line known to
everyone, is hot: the runs are asked for at once, and only two of them travel, to tell those of
other batches. What hot marks ask for is told apart by content later. So no bucket gets more
than a few rows a batch for one mark. Rows between the steps are ``kind, bucket, weight, data``: packed arrays for a bucket."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import cut, kept
from tidemark.llm.texts import (BYTE_VALUES, CHUNK, Batch, Hashes, mix, pack, sliced, sliding_min,
                                unpack, unpack_all, word_values, words)

SCHEMA = "kind int, bucket int, weight long, data binary"
#: Kinds of rows: runs by mark, windows covered, runs asked for, windows by content, texts.
RUNS, COVERED, ASKED, WINDOWS, TEXTS = range(5)

#: Arrays of each kind. ``tag`` is a checksum of the text, which tells rows of one id apart.
COLUMNS = {
    RUNS: ("u8", "u8", "i8", "u4", "u4", "u1", "u1", "u1"),  # mark, content, doc_id, tag, first, windows and flags, sides
    COVERED: ("i8", "u4", "u4", "u4"),  # doc_id, tag, first window, last window
    ASKED: ("i8", "u4", "u4", "u1", "u8", "u1"),  # doc_id, tag, first, windows, mark, hot
}
#: Added to the number of windows: in two runs that stand for many of a mark in a batch, and in
#: those whose sides say nothing. The number of classes of a mark, in a batch and in all, from
#: which it is hot.
HOT, ANY, MANY, MANY_IN_ALL = 0x80, 0x40, 32, 1000
_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("weight", pa.int64()), ("data", pa.binary())])


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of 64-bit keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def doc_bucket(doc_ids: np.ndarray, buckets: int) -> np.ndarray:
    return bucket_of(mix(doc_ids.view(np.uint64) + np.uint64(0x51)), buckets)


def rows_of(kind: int, where: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple]:
    """One row for each bucket, in the order things had."""
    if not where.size:
        return
    order = np.argsort(where, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(where[order]) != 0, True])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = order[a:b]
        yield kind, int(where[own[0]]), int(own.size), pack(*(array[own] for array in arrays))


def passed_on(rows: pa.Table, kind: int) -> list[tuple]:
    return [row for row in zip(*(rows[field.name].to_pylist() for field in _ARROW), strict=True) if row[0] == kind]


def table_of(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.table([pa.array(column, field.type) for column, field in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def covered_rows(doc_ids: np.ndarray, tags: np.ndarray, first: np.ndarray, last: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Stretches of covered windows, joined where they touch."""
    if not doc_ids.size:
        return
    order = np.lexsort((first, tags, doc_ids))
    doc_ids, tags, first, last = doc_ids[order], tags[order], first[order].astype(np.int64), last[order].astype(np.int64)
    new = np.r_[True, (doc_ids[1:] != doc_ids[:-1]) | (tags[1:] != tags[:-1])]
    # Stretches of one text, shifted apart from those of others, to take a running maximum.
    shift = (np.cumsum(new) - 1) * (1 << 33)
    reach = np.maximum.accumulate(last + shift)
    new[1:] |= first[1:] + shift[1:] > reach[:-1] + 1
    starts = np.flatnonzero(new)
    ends = np.r_[starts[1:], new.size] - 1
    yield from rows_of(COVERED, doc_bucket(doc_ids[starts], buckets), doc_ids[starts], tags[starts],
                       first[starts].astype(np.uint32), (reach[ends] - shift[ends]).astype(np.uint32))


def _cut_runs(units: np.ndarray, bounds: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Mark, content, first window and number of windows of the runs of pieces of units."""
    count = units.size - width + 1
    if count <= 0:
        return _NO_RUNS
    hashes = Hashes(units)
    grams = hashes.all_of(gram)
    marks = sliding_min(grams, width - gram + 1)
    # Windows that reach over the end of a piece are none.
    edge = np.zeros(units.size + 1, dtype=np.int32)
    inner = bounds[1:][bounds[1:] > bounds[:-1]]
    np.add.at(edge, np.maximum(inner - width + 1, bounds[:-1][bounds[1:] > bounds[:-1]]), 1)
    np.add.at(edge, inner, -1)
    valid = np.cumsum(edge[:count]) == 0
    new = valid.copy()
    new[1:] &= (marks[1:] != marks[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new)
    if not first.size:
        return _NO_RUNS
    after = np.cumsum(valid)
    sizes = np.diff(np.r_[after[first] - 1, after[-1]])
    # Long runs, of repetitions, are cut, so that first and last window make up a run.
    times = -(-sizes // width)
    place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    first = np.repeat(first, times) + place * width
    sizes = np.minimum(np.repeat(sizes, times) - place * width, width)
    last = first + sizes - 1
    content = mix(hashes.of(first, first + width) * np.uint64(3) + hashes.of(last, last + width) * np.uint64(5) + sizes.astype(np.uint64))
    left, right, several = _sides(hashes, grams, marks, first, last, width, gram)
    return mix(marks[first]), content, first, sizes | several, left, right


def _sides(hashes: Hashes, grams: np.ndarray, marks: np.ndarray, first: np.ndarray, last: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """A byte of hash of what is left and right of the gram that marks each run, and ``ANY`` for
    runs that hold their mark more than once. A window that two runs of one mark have in common
    reaches at least half of what the gram leaves of it to one side, and there they agree. Where
    a text ends before that, the byte is of the place; with several grams it says nothing."""
    span = width - gram + 1
    # A gram is a mark of some window if it is the greatest of the marks around it.
    around = np.zeros(grams.size + span - 1, dtype=np.uint64)
    around[span - 1 : span - 1 + marks.size] = marks
    chosen = grams == ~sliding_min(~around, span)
    before = np.zeros(grams.size + 1, dtype=np.int64)
    np.cumsum(chosen, out=before[1:])
    places = np.flatnonzero(chosen)
    at, end = before[first], before[np.minimum(last + span, grams.size)]
    place, found = np.zeros(first.size, dtype=np.int64), np.zeros(first.size, dtype=np.int64)
    rows = np.flatnonzero(at < end)
    while rows.size:
        own = places[at[rows]]
        hit = rows[grams[own] == marks[first[rows]]]
        place[hit] = places[at[hit]]
        found[hit] += 1
        at[rows] += 1
        rows = rows[at[rows] < end[rows]]
    reach, total = (width - gram) // 2, hashes.sums.size - 1
    left, right = np.maximum(place - reach, 0), np.minimum(place + gram + reach, total)
    sides = [(hashes.of(a, b) >> np.uint64(56)).astype(np.uint8) for a, b in ((left, place), (place + gram, right))]
    return *sides, np.where(found == 1, 0, ANY)


_NO_RUNS = tuple(np.zeros(0, kind) for kind in ("u8", "u8", "i8", "i8", "u1", "u1"))


def byte_units(batch: Batch, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    bounds = batch.bounds[start : end + 1]
    return BYTE_VALUES[batch.data[bounds[0] : bounds[-1]]], bounds - bounds[0]


def word_units(batch: Batch, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, before = words(batch.data, batch.bounds[start : end + 1])
    return word_values(batch.data, starts, ends), before


Units = Callable[[Batch, int, int], tuple[np.ndarray, np.ndarray]]


def batch_runs(batch: Batch, units: Units, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of all texts of a batch: mark, content, text, first window, windows, sides."""
    found: list[list[np.ndarray]] = [[np.zeros(0, kind)] for kind in ("u8", "u8", "i8", "i8", "i8", "u1", "u1")]
    for start, end in batch.chunks():
        values, bounds = units(batch, start, end)
        # A text longer than a chunk goes in pieces that overlap by less than a window.
        for low in range(0, max(values.size - width + 1, 1), CHUNK) if end - start == 1 else (0,):
            high = min(low + CHUNK + width - 1, values.size) if end - start == 1 else values.size
            own = np.array([0, high - low]) if end - start == 1 else bounds
            mark, content, first, sizes, *sides = _cut_runs(values[low:high], own, width, gram)
            text = np.searchsorted(own, first, side="right") - 1
            for column, part in zip(found, (mark, content, text + start, first + low - (own[text] if end - start > 1 else 0), sizes, *sides), strict=True):
                column.append(part)
    return tuple(np.concatenate(column) for column in found)


def _classes(mark: np.ndarray, content: np.ndarray, doc_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the rows whose mark is not alone: their order by mark, content and document, the first
    row of each one's class, and the first of each one's mark, as places in that order."""
    order = np.argsort(mark, kind="stable")
    same = mark[order[1:]] == mark[order[:-1]]
    order = order[np.r_[same, False] | np.r_[False, same]] if order.size else order
    order = order[np.lexsort((doc_ids[order], content[order], mark[order]))]
    m, c, place = mark[order], content[order], np.arange(order.size)
    new_mark = np.r_[True, m[1:] != m[:-1]][: order.size]
    new_class = (new_mark | np.r_[True, c[1:] != c[:-1]][: order.size])
    return order, np.maximum.accumulate(np.where(new_class, place, 0)) if order.size else place, np.maximum.accumulate(np.where(new_mark, place, 0)) if order.size else place


def _scan(units: Units, width: int, gram: int, buckets: int, doc_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches):
            batch = Batch(rows.column(1))
            ids = np.asarray(rows.column(0).fill_null(0)).astype(np.int64)
            tags = np.array([zlib.crc32(batch.bytes_of(i)) for i in range(len(batch))], dtype=np.uint32)
            mark, content, text, first, flagged, left, right = batch_runs(batch, units, width, gram)
            sizes = flagged & (ANY - 1)
            order, head, _ = _classes(mark, content, ids[text])
            copies = order[ids[text[order]] != ids[text[order[head]]]]
            hot, sizes_out = [np.zeros(0, np.int64)], flagged.astype(np.uint8)
            out = list(covered_rows(ids[text[copies]], tags[text[copies]], first[copies], first[copies] + sizes[copies] - 1, doc_buckets))
            stay = np.ones(mark.size, dtype=bool)
            stay[copies] = False
            own = order[stay[order]]
            starts = np.flatnonzero(np.r_[True, mark[own[1:]] != mark[own[:-1]]]) if own.size else own
            ends = np.r_[starts[1:], own.size]
            for a, b in zip(starts[ends - starts > MANY], ends[ends - starts > MANY], strict=True):
                runs = own[a:b]
                least, most = runs[np.argmin(ids[text[runs]])], runs[np.argmax(ids[text[runs]])]
                if ids[text[least]] == ids[text[most]]:
                    continue
                hot.append(runs)
                stay[runs] = False
                stay[[least, most]] = True
                sizes_out[[least, most]] |= HOT
            asked = np.concatenate(hot)
            out += rows_of(ASKED, doc_bucket(ids[text[asked]], doc_buckets), ids[text[asked]], tags[text[asked]], first[asked].astype(np.uint32),
                           sizes[asked].astype(np.uint8), mark[asked], np.ones(asked.size, np.uint8))
            mark, content, text, first, sizes, left, right = (a[stay] for a in (mark, content, text, first, sizes_out, left, right))
            out += rows_of(RUNS, bucket_of(mark, buckets), mark, content, ids[text], tags[text], first.astype(np.uint32), sizes, left, right)
            yield from table_of(out).to_batches()

    return run


def _meet(doc_buckets: int):
    """Classes of all runs of a bucket: covered ones, and representatives that are asked for."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() != RUNS:
            return table
        mark, content, ids, tags, first, flagged, left, right = unpack_all(table["data"].to_pylist(), COLUMNS[RUNS])
        sizes = flagged & (ANY - 1)
        order, head, group = _classes(mark, content, ids)
        own = ids[order]
        copy = own != own[head]
        copies = order[copy]
        out = list(covered_rows(ids[copies], tags[copies], first[copies], first[copies] + sizes[copies].astype(np.uint32) - 1, doc_buckets))
        # A mark with one class, or whose classes are all of one document, has nothing in common.
        starts = np.flatnonzero(group == np.arange(group.size))
        if starts.size:
            low, high = np.minimum.reduceat(own, starts), np.maximum.reduceat(own, starts)
            ends = np.r_[starts[1:], own.size]
            classes = np.add.reduceat((head == np.arange(head.size)).astype(np.int64), starts)
            hot = (classes > MANY_IN_ALL) | np.logical_or.reduceat(flagged[order] >= HOT, starts)
            any_side = np.repeat(hot | np.logical_or.reduceat((flagged[order] & ANY) > 0, starts), ends - starts)
            hot = np.repeat(hot, ends - starts)
            wanted = np.repeat((classes > 1) & (low != high), ends - starts) & ~copy
            wanted &= any_side | _shared(group, left[order], own, wanted) | _shared(group, right[order], own, wanted)
            asked, hot = order[wanted], hot[wanted]
            out += rows_of(ASKED, doc_bucket(ids[asked], doc_buckets), ids[asked], tags[asked], first[asked], sizes[asked], mark[asked], hot.astype(np.uint8))
        return table_of(out)

    return run


def _shared(group: np.ndarray, side: np.ndarray, ids: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of the rows ``among`` have the mark and this side in common with another document."""
    rows, out = np.flatnonzero(among), np.zeros(group.size, dtype=bool)
    rows = rows[np.lexsort((side[rows], group[rows]))]
    new = np.r_[True, (group[rows[1:]] != group[rows[:-1]]) | (side[rows[1:]] != side[rows[:-1]])][: rows.size]
    starts = np.flatnonzero(new)
    if starts.size:
        low, high = np.minimum.reduceat(ids[rows], starts), np.maximum.reduceat(ids[rows], starts)
        out[rows] = np.repeat(low != high, np.diff(np.r_[starts, rows.size]))
    return out


def grouped(df: DataFrame, function, name: str) -> DataFrame:
    """``function`` on all rows of a kind and bucket, written."""
    return kept(df.groupBy("kind", "bucket").applyInArrow(function, SCHEMA), name)


def find_runs(docs: DataFrame, units: Units, width: int, gram: int, buckets: int, doc_buckets: int) -> DataFrame:
    """Rows of ``COVERED`` and ``ASKED`` for ``docs`` of ``doc_id, text``; NULL ids take no part."""
    scanned = docs.where(F.col("doc_id").isNotNull()).mapInArrow(_scan(units, width, gram, buckets, doc_buckets), SCHEMA)
    return grouped(scanned, _meet(doc_buckets), "runs")


def packed_texts(docs: DataFrame, doc_buckets: int) -> DataFrame:
    """Texts by bucket of their document, compressed for the shuffle. Rows with a NULL id meet
    nothing; they are marked, and dealt to all buckets in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for rows in sliced(batches):
            batch, out = Batch(rows.column(1)), []
            ids = np.asarray(rows.column(0).fill_null(0)).astype(np.int64)
            known = np.asarray(rows.column(0).is_valid())
            turn = ((np.arange(ids.size) + len(batch) * 7919) % doc_buckets).astype(np.int32)
            where = np.where(known, doc_bucket(ids, doc_buckets), turn)
            order = np.argsort(where, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(where[order]) != 0, True])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = order[a:b]
                body = squeeze(b"".join(bytes(batch.bytes_of(i)) for i in own))
                head = pack(ids[own], known[own].view(np.uint8), np.diff(batch.bounds)[own], np.frombuffer(body, np.uint8))
                out.append((TEXTS, int(where[own[0]]), int(own.size), head))
            yield from table_of(out).to_batches()

    return cut(docs, doc_id="doc_id", text="text").mapInArrow(run, SCHEMA)


class Texts:
    """Texts of one bucket, laid end to end."""

    def __init__(self, values: list[bytes]) -> None:
        expand = zstandard.ZstdDecompressor().decompress
        columns = [unpack(value) for value in values]
        none = np.zeros(0, np.int64)
        self.ids = np.concatenate([none, *(c[0] for c in columns)])
        self.known = np.concatenate([none, *(c[1] for c in columns)]).astype(bool)
        self.bounds = np.r_[0, np.cumsum(np.concatenate([none, *(c[2] for c in columns)]))]
        self.data = np.frombuffer(b"".join(expand(c[3].tobytes()) for c in columns), dtype=np.uint8)

    def bytes_of(self, i: int) -> memoryview:
        return memoryview(self.data[self.bounds[i] : self.bounds[i + 1]])

    def rows_of(self, ids: np.ndarray, tags: np.ndarray) -> dict[tuple[int, int], list[int]]:
        """Rows of the texts that are named by id and checksum."""
        wanted = set(zip(ids.tolist(), tags.tolist(), strict=True))
        names = {i for i, _ in wanted}
        found: dict[tuple[int, int], list[int]] = {}
        for row, (i, known) in enumerate(zip(self.ids.tolist(), self.known.tolist(), strict=True)):
            if known and i in names:
                name = i, zlib.crc32(self.bytes_of(row))
                if name in wanted:
                    found.setdefault(name, []).append(row)
        return found


def by_text(values: list[bytes], kind: int) -> Iterator[tuple[tuple[int, int], list[np.ndarray]]]:
    """Packed rows of a kind, joined and dealt out by the text they name."""
    columns = unpack_all(values, COLUMNS[kind])
    order = np.lexsort((columns[2], columns[1], columns[0]))
    columns = [column[order] for column in columns]
    cuts = np.flatnonzero(np.r_[True, (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1]), True]) if order.size else [0]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield (int(columns[0][a]), int(columns[1][a])), [column[a:b] for column in columns]


def with_texts(docs: DataFrame, rows: DataFrame, doc_buckets: int, function, schema) -> DataFrame:
    """``function`` on the texts and the ``rows`` of each bucket of documents."""
    texts = packed_texts(docs, doc_buckets).groupBy("bucket")

    def run(texts: pa.Table, rows: pa.Table) -> pa.Table:
        return function(Texts(texts["data"].to_pylist()), rows)

    return texts.cogroup(rows.groupBy("bucket")).applyInArrow(run, schema)
