"""Substring deduplication by words: automata of the passages that recur."""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.frames import cut, parts, text_bytes
from tidemark.llm.runs import (ASKED, COVERED, SCHEMA, WINDOWS, Texts, bucket_of, by_text,
                               covered_rows, find_runs, grouped, passed_on, table_of,
                               with_texts, word_units)
from tidemark.llm.texts import Hashes, pack, unpack, word_values, words

#: Words of a window, and of the grams that mark windows.
WIDTH, GRAM = 50, 10
#: Bytes of text for a bucket, runs for a shard, and windows whose automaton is in memory at a time.
BUCKET_BYTES, SHARD_RUNS, AUTOMATON = 8 << 20, 4000, 20_000


def _passages(texts: Texts, rows: pa.Table, shards: int) -> pa.Table:
    """The words of the runs that are asked for, by the shard of their mark. Runs of hot marks
    are taken apart into windows, each by the shard of its content."""
    out = passed_on(rows, COVERED)
    named = list(by_text([row[3] for row in passed_on(rows, ASKED)], ASKED))
    found = texts.rows_of(np.array([n[0] for n, _ in named], dtype=np.int64), np.array([n[1] for n, _ in named], dtype=np.int64))
    keys, ids, tags, firsts, sizes, bodies = [], [], [], [], [], []

    def add(key: int, name: tuple[int, int], first: int, size: int, own: list[bytes]) -> None:
        keys.append(key)
        ids.append(name[0])
        tags.append(name[1])
        firsts.append(first)
        sizes.append(size)
        bodies.append(b" ".join(own[first : first + size + WIDTH - 1]))

    for name, (_, _, first, count, mark, hot) in named:
        for row in found.get(name, [])[:1]:  # rows of one name have one text
            body = texts.bytes_of(row)
            own = bytes(body).split()
            hashes = None
            for key, begin, size, apart in dict.fromkeys(zip(mark.tolist(), first.tolist(), count.tolist(), hot.tolist(), strict=True)):
                if not apart:
                    add(key, name, begin, size, own)
                    continue
                if hashes is None:
                    starts, ends, _ = words(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
                    hashes = Hashes(word_values(np.frombuffer(body, np.uint8), starts, ends))
                at = np.arange(begin, begin + size)
                for window, content in zip(at.tolist(), hashes.of(at, at + WIDTH).tolist(), strict=True):
                    add(content, name, window, 1, own)
    keys = np.array(keys, dtype=np.uint64)
    where = bucket_of(keys, shards)
    order = np.argsort(where, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(where[order]) != 0, True]) if order.size else [0]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = order[a:b]
        body = b"".join(bodies[i] for i in own)
        lengths = np.array([len(bodies[i]) for i in own], dtype=np.int64)
        out.append((WINDOWS, int(where[own[0]]), int(own.size), pack(
            keys[own], np.array(ids, np.int64)[own], np.array(tags, np.uint32)[own], np.array(firsts, np.int64)[own], np.array(sizes, np.int64)[own],
            lengths, np.frombuffer(body, np.uint8))))
    return table_of(out)


def recurring(sequences: list[tuple[int, ...]], ids: list[int]) -> dict[tuple[int, ...], int]:
    """Windows that are in several documents, each with the smallest of them."""
    least: dict[tuple[int, ...], int] = {}
    several = set()
    for sequence, doc_id in zip(sequences, ids, strict=True):
        for i in range(len(sequence) - WIDTH + 1):
            window = sequence[i : i + WIDTH]
            known = least.setdefault(window, doc_id)
            if known != doc_id:
                several.add(window)
                least[window] = min(known, doc_id)
    return {window: least[window] for window in several}


def locate(patterns: dict[tuple[int, ...], int], sequences: list[tuple[int, ...]]):
    """Every occurrence of a pattern, as number of the sequence, place of its first word, and
    what the pattern stands for, from one Aho-Corasick automaton over words."""
    if not patterns:
        return
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for pattern, value in patterns.items():
        automaton.add_word(pattern, value)
    automaton.make_automaton()
    for number, sequence in enumerate(sequences):
        for end, value in automaton.iter(sequence):
            yield number, end - WIDTH + 1, value


def _search(doc_buckets: int):
    """Confirm what recurs in a shard, compile it to automata, and stream the shard's share of
    all documents through them. Marks are taken together up to the size of an automaton."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() != WINDOWS:
            return table
        columns = [unpack(value) for value in table["data"].to_pylist()]
        keys, ids, tags, first, sizes, lengths = (np.concatenate([c[i] for c in columns]) for i in range(6))
        body = b"".join(c[6].tobytes() for c in columns)
        bounds = np.r_[0, np.cumsum(lengths)]
        order = np.argsort(keys, kind="stable")
        total = np.cumsum(sizes[order])
        new = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
        steps, begin = [], 0
        for end in [*new[1:].tolist(), order.size]:
            if total[end - 1] - (total[begin - 1] if begin else 0) >= AUTOMATON or end == order.size:
                steps.append(order[begin:end])
                begin = end
        found: list[tuple[int, int]] = []
        for own in steps:
            numbers: dict[bytes, int] = {}
            sequences = [tuple(numbers.setdefault(w, len(numbers)) for w in body[bounds[i] : bounds[i + 1]].split(b" ")) for i in own]
            patterns = recurring(sequences, ids[own].tolist())
            found += [(int(own[n]), place) for n, place, least in locate(patterns, sequences) if least < ids[own[n]]]
        runs = np.array([r for r, _ in found], dtype=np.int64)
        at = first[runs] + np.array([p for _, p in found], dtype=np.int64)
        return table_of(list(covered_rows(ids[runs], tags[runs], at, at, doc_buckets)))

    return run


def _left(texts: Texts, rows: pa.Table, names: list[str]) -> pa.Table:
    covered = dict(by_text(rows["data"].to_pylist(), COVERED))
    found = texts.rows_of(np.array([n[0] for n in covered], dtype=np.int64), np.array([n[1] for n in covered], dtype=np.int64))
    stretches = {row: covered[name] for name, own in found.items() for row in own}
    counts, removed, digests = [], [], []
    for row in range(texts.ids.size):
        own = bytes(texts.bytes_of(row)).split()
        counts.append(len(own))
        if row in stretches:
            _, _, begin, end = stretches[row]
            edge = np.zeros(len(own) + 1, dtype=np.int32)
            np.add.at(edge, begin.astype(np.int64), 1)
            np.add.at(edge, end.astype(np.int64) + WIDTH, -1)
            stay = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
            own = [own[i] for i in stay]
        removed.append(counts[-1] - len(own))
        digests.append(hashlib.sha256(b" ".join(own)).hexdigest())
    ids = pa.array(texts.ids, mask=~texts.known)
    return pa.table([ids, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], names=names)


def remove_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove from each text the words that a window of 50 words covers which also starts in a
    document of a smaller id. Words are what blanks, tabs and line ends leave between them,
    unchanged; windows are judged on the texts as they came, whole.

    Returns ``doc_id, n_words, n_removed, kept_sha256``, a row for a row. NULL and empty texts
    have no words; rows with a NULL id take no part and lose nothing; rows of one id are one
    document, which loses nothing to itself.

    Passages that are equal over a whole run in an earlier document are confirmed by hashes (see
    :mod:`tidemark.llm.runs`). The rest of what may recur, where passages begin and end, goes to
    shards by content, from all documents: there, recurring windows are confirmed word by word,
    compiled to Aho-Corasick automata, and every occurrence is located. An occurrence can only be
    where the run it is in was sent, so a document visits only the shards of its own runs."""
    docs = cut(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    _, size = text_bytes(docs)
    buckets = parts(size, BUCKET_BYTES)
    found = find_runs(docs, word_units, WIDTH, GRAM, buckets, buckets)
    asked = found.where(F.col("kind") == ASKED).agg(F.sum("weight")).first()[0] or 0
    shards = parts(asked, SHARD_RUNS)
    dealt = with_texts(docs, found, buckets, lambda texts, own: _passages(texts, own, shards), SCHEMA)
    covered = grouped(dealt, _search(buckets), "passages")
    fields = [StructField("doc_id", LongType()), StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType())]
    names = [field.name for field in fields]
    return with_texts(docs, covered, buckets, lambda texts, own: _left(texts, own, names), StructType(fields))
