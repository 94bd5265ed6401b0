"""Near-duplicates: SuperMinHash signatures, banding, verification and union-find grouping."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.frames import cut, kept, parts
from tidemark.llm.texts import Batch, Hashes, mix, sliced, word_values, words

#: Words of a shingle; registers of a signature, and of a band.
WORDS, REGISTERS, ROWS = 5, 128, 4
#: Links have at least this part of their union in common.
PART = 75
#: Signatures must agree in this part of their registers to be compared in full: five standard
#: errors below the least link, so that this loses fewer links than the bands do.
LIKELY = 0.55
#: Members of a bucket, and shingles of a family, that are compared in one piece.
MEMBERS, SHINGLES = 512, 1 << 20

#: A-Z in lower case.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_sets(batch: Batch) -> Iterator[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text: five words in a row, or all words of
    a text that has fewer. A text without words has none."""
    lower = Batch.__new__(Batch)
    lower.bounds, lower.data = batch.bounds, _LOWER[batch.data]
    for start, end in lower.chunks():
        starts, ends, before = words(lower.data, lower.bounds[start : end + 1])
        values = word_values(lower.data, starts, ends)
        hashes = Hashes(values)
        full = hashes.all_of(WORDS) if values.size >= WORDS else np.zeros(0, np.uint64)
        for a, b in zip(before[:-1], before[1:], strict=True):
            if b - a >= WORDS:
                yield np.unique(full[a : b - WORDS + 1])
            elif b > a:
                yield mix(hashes.of(np.array([a]), np.array([b])) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash of each set, none of them empty: a row of registers.

    Every element goes through the registers in an order of its own, a random permutation made
    step by step, and offers at its step j the value j plus a fraction; a register keeps the
    least offer. As an element's offers are spread over all registers, signatures vary less than
    with independent permutations. A set is done when its greatest register is below the step.
    Elements of many sets take a step together; a register is held as 8 bits of step and 24 of
    fraction."""
    out = np.full((len(sets), REGISTERS), np.iinfo(np.uint32).max, dtype=np.uint32)
    order = sorted(range(len(sets)), key=lambda i: sets[i].size)
    begin = 0
    while begin < len(order):
        end, total = begin, 0
        while end < len(order) and (end == begin or total + sets[order[end]].size <= 1 << 15):
            total += sets[order[end]].size
            end += 1
        own = order[begin:end]
        out[own] = _together([sets[i] for i in own])
        begin = end
    return out


def _together(sets: list[np.ndarray]) -> np.ndarray:
    registers = np.full(len(sets) * REGISTERS, np.iinfo(np.uint32).max, dtype=np.uint32)
    # A set far larger than the signature goes in slices; registers are least offers over all.
    if len(sets) == 1 and sets[0].size > 1 << 16:
        return np.minimum.reduce([_together([sets[0][i : i + (1 << 15)]]) for i in range(0, sets[0].size, 1 << 15)])
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [s.size for s in sets])
    places = np.broadcast_to(np.arange(REGISTERS, dtype=np.uint8), (elements.size, REGISTERS)).copy()
    for step in range(REGISTERS):
        random = mix(elements + np.uint64(0x9E3779B97F4A7C15 * (step + 1) % (1 << 64)))
        swap = step + ((random & np.uint64(0xFFFFFFFF)) % np.uint64(REGISTERS - step)).astype(np.int64)
        row = np.arange(elements.size)
        chosen = places[row, swap]
        places[row, swap] = places[:, step]
        offer = np.uint32(step << 24) | (random >> np.uint64(40)).astype(np.uint32)
        np.minimum.at(registers, owner * REGISTERS + chosen, offer)
        open_sets = registers.reshape(-1, REGISTERS).max(axis=1) >= (step + 1) << 24
        if not open_sets.any():
            break
        stay = open_sets[owner]
        if stay.mean() < 0.7:
            elements, owner, places = elements[stay], owner[stay], places[stay]
    return registers.reshape(-1, REGISTERS)


def _described(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key``, ``set`` (a digest of all shingles), ``n_shingles``, and for one row of
    each set in a batch its bands' hashes and a byte of every register."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches):
            batch = Batch(rows.column(1))
            digests, counts, own, first = [], [], {}, []
            for i, shingles in enumerate(shingle_sets(batch)):
                counts.append(shingles.size)
                digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if shingles.size else None
                digests.append(digest)
                if digest is not None and digest not in own:
                    own[digest] = shingles
                    first.append(i)
            bands, sketch = [None] * len(batch), [None] * len(batch)
            if first:
                registers = signatures(list(own.values()))
                grouped = registers.reshape(len(first), -1, ROWS).astype(np.uint64)
                keys = np.zeros(grouped.shape[:2], dtype=np.uint64) + np.arange(grouped.shape[1], dtype=np.uint64)
                for i in range(ROWS):
                    keys = mix(keys * np.uint64(31) + grouped[:, :, i])
                short = (mix(registers.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                for place, i in enumerate(first):
                    bands[i], sketch[i] = keys[place].tobytes(), short[place].tobytes()
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(2), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(bands, pa.binary()), pa.array(sketch, pa.binary())],
                ["doc_id", "key", "set", "n_shingles", "bands", "sketch"])

    schema = "doc_id long, key long, set binary, n_shingles long, bands binary, sketch binary"
    return docs.mapInArrow(run, schema)


def _bands(sets: DataFrame) -> DataFrame:
    """``key, rep`` for every band of a set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64)
            reps = np.repeat(np.asarray(batch.column(0)), REGISTERS // ROWS)
            for a in range(0, keys.size, 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + (1 << 16)]), pa.array(reps[a : a + (1 << 16)])], ["key", "rep"])

    return sets.select("rep", "bands").mapInArrow(run, "key long, rep long")


def _in_pieces(df: DataFrame, pieces: Column, by: str) -> DataFrame:
    """Rows of groups that are too large for one task, dealt to all pairs of the group's pieces;
    rows of all others as they are. ``left`` and ``right`` name the pair."""
    own = F.when(pieces > 1, F.pmod(F.xxhash64(by), pieces)).otherwise(F.lit(0))
    return (
        df.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(pieces, F.lit(1)) - 1)))
        .withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other")).drop("own", "other")
    )


def _groups(key: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[np.ndarray]:
    order = np.lexsort((right, left, key))
    k, a, b = key[order], left[order], right[order]
    cuts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]), True]) if order.size else np.zeros(1, np.int64)
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        yield order[begin:end]


def _edges(pairs: list[tuple[int, int]]) -> pa.Table:
    array = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(array[:, 0]), "b": pa.array(array[:, 1])})


def _spanned(count: int, linked) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among ``count`` members: each is compared only with those
    that no tree has yet. ``linked(i, rest)`` tells which of ``rest`` member i is linked with."""
    rest = np.arange(count)
    while rest.size:
        queue, rest = [rest[0]], rest[1:]
        while queue and rest.size:
            i = queue.pop()
            hit = linked(i, rest)
            for j in rest[hit]:
                yield int(i), int(j)
                queue.append(j)
            rest = rest[~hit]


def _likely(table: pa.Table) -> pa.Table:
    """Links between sets of one bucket whose signatures agree well."""
    key, reps, left, right = (np.asarray(table[c].combine_chunks()) for c in ("key", "rep", "left", "right"))
    short = np.frombuffer(b"".join(table["sketch"].to_pylist()), dtype=np.uint8).reshape(-1, REGISTERS)
    pairs = set()
    for own in _groups(key, left, right):
        own = own[np.unique(reps[own], return_index=True)[1]]
        sketches = short[own]
        need = int(np.ceil(LIKELY * REGISTERS))
        for i, j in _spanned(own.size, lambda i, rest, s=sketches: (s[rest] == s[i]).sum(axis=1) >= need):
            pairs.add((int(reps[own[i]]), int(reps[own[j]])))
    return _edges(sorted(pairs))


def _verified(table: pa.Table) -> pa.Table:
    """Links between full sets of one family."""
    key, reps, left, right = (np.asarray(table[c].combine_chunks()) for c in ("family", "rep", "left", "right"))
    bodies = table["shingles"].to_pylist()
    pairs: list[tuple[int, int]] = []
    for own in _groups(key, left, right):
        own = own[np.unique(reps[own], return_index=True)[1]]
        sets = [np.frombuffer(bodies[i], dtype=np.uint64) for i in own]
        sizes = np.array([s.size for s in sets])
        _, dense = np.unique(np.concatenate(sets), return_inverse=True)
        bounds = np.r_[0, np.cumsum(sizes)]
        here = np.zeros(dense.max() + 1 if dense.size else 0, dtype=bool)

        def linked(i: int, rest: np.ndarray, sizes=sizes, dense=dense, bounds=bounds, here=here) -> np.ndarray:
            mine = dense[bounds[i] : bounds[i + 1]]
            here[mine] = True
            common = np.array([np.count_nonzero(here[dense[bounds[j] : bounds[j + 1]]]) for j in rest])
            here[mine] = False
            return 100 * common >= PART * (sizes[i] + sizes[rest] - common)

        pairs += [(int(reps[own[i]]), int(reps[own[j]])) for i, j in _spanned(own.size, linked)]
    return _edges(pairs)


def _shingles(docs: DataFrame) -> DataFrame:
    """The shingles of those rows whose set is the one that is wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches):
            wanted, keep, bodies = rows.column(2).to_pylist(), [], []
            for i, shingles in enumerate(shingle_sets(Batch(rows.column(1)))):
                body = shingles.tobytes()
                if hashlib.blake2b(body, digest_size=16).digest() == wanted[i]:
                    keep.append(i)
                    bodies.append(body)
            at = pa.array(keep, pa.int32())
            yield pa.RecordBatch.from_arrays([rows.column(0).take(at), rows.column(3).take(at), rows.column(4).take(at), pa.array(bodies, pa.binary())], ["rep", "family", "pieces", "shingles"])

    return docs.mapInArrow(run, "rep long, family long, pieces long, shingles binary")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Group documents that are linked, directly or over others, by shingles: at least three
    quarters of the union of two sets in common.

    Returns ``doc_id, n_shingles, component_id, kept``, a row for a row; ``component_id`` is the
    smallest id of the group and ``kept`` whether it is the row's own. Texts that are NULL, empty
    or without words have no shingles and are alone; a NULL id takes no part, has a NULL
    component and is kept; rows of one id are one document, linked by what any of its texts is
    linked with.

    Texts with equal sets are one class, found by digest. Classes that share a band of their
    signatures, and agree in enough of it, are joined to families by union-find; a pair at the
    threshold shares none of 32 bands of four registers with a chance below one in 100,000. In a
    family the full sets are compared until all are linked or told apart. Neither step makes all
    pairs: who is linked is not compared again. Buckets and families too large for a task are
    cut into pieces and every pair of pieces is compared."""
    docs = cut(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("key", F.xxhash64("text"))
    described = kept(_described(docs), "described")
    # Sets are what is linked, each by a number of its own and by the place of one of its texts.
    sets = kept(
        described.where(F.col("doc_id").isNotNull() & F.col("set").isNotNull())
        .groupBy("set").agg(F.min(F.struct("doc_id", "key")).alias("at"), F.max("n_shingles").alias("n_shingles"), F.max("bands").alias("bands"), F.max("sketch").alias("sketch"))
        .select(F.monotonically_increasing_id().alias("rep"), "set", "at.doc_id", "at.key", "n_shingles", "bands", "sketch"),
        "sets")
    keys = _bands(sets)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    members = keys.join(shared, "key").join(sets.select("rep", "sketch"), "rep")
    members = kept(_in_pieces(members, F.ceil(F.col("members") / MEMBERS), "rep"), "members")
    buckets = parts(members.count(), 5_000, least=96)
    place = F.pmod(F.xxhash64("key", "left", "right"), F.lit(buckets))
    likely = members.withColumn("bucket", place).groupBy("bucket").applyInArrow(_likely, "a long, b long")
    families = components(likely, "families").select(F.col("node").alias("rep"), F.col("component").alias("family"))

    wanted = families.join(sets.select("rep", "set", "doc_id", "key", "n_shingles"), "rep")
    weights = wanted.groupBy("family").agg(F.ceil(F.sum("n_shingles") / SHINGLES).alias("pieces"))
    wanted = wanted.join(weights, "family").select("doc_id", "key", "rep", "set", "family", "pieces")
    full = _shingles(docs.join(wanted, ["doc_id", "key"]).select("rep", "text", "set", "family", "pieces"))
    full = kept(_in_pieces(full, F.col("pieces"), "rep"), "shingles")
    amount = full.agg(F.sum(F.octet_length("shingles").cast("long"))).first()[0] or 0
    place = F.pmod(F.xxhash64("family", "left", "right"), F.lit(parts(amount, 6 << 20, least=96)))
    links = full.withColumn("bucket", place).groupBy("bucket").applyInArrow(_verified, "a long, b long")
    grouped = components(links.select("a", "b").union(_of_one_id(described, sets)), "links")

    # The number of a group is the smallest id of its sets.
    placed = sets.select("rep", "set", "doc_id").join(grouped.select(F.col("node").alias("rep"), "component"), "rep", "left")
    placed = placed.withColumn("component", F.coalesce("component", "rep"))
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(least, "component").select("set", "component_id")
    rows = described.select("doc_id", "set", "n_shingles").join(named, "set", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _of_one_id(described: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the sets of documents that have several under one id: each to the least. The
    ids are counted first, so that only theirs are joined."""
    owners = described.where(F.col("doc_id").isNotNull() & F.col("set").isNotNull()).select("doc_id", "set")
    several = owners.groupBy("doc_id").agg(F.min("set").alias("one"), F.max("set").alias("other")).where(F.col("one") < F.col("other"))
    own = owners.join(several.select("doc_id"), "doc_id").distinct().join(sets.select("rep", "set"), "set").select("doc_id", "rep")
    least = own.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return own.join(least, "doc_id").where(F.col("rep") != F.col("a")).select("a", F.col("rep").alias("b"))
