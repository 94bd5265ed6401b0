"""Byte-level BPE with the tiktoken library and a rank file on local disk."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.frames import cut

#: Characters of a text that go to the library at a time.
PIECE = 1 << 16
#: A run of white space from which on the library's own pattern may run out of stack.
LONG_RUN = 1 << 13

# A match of the pattern holds white space only at its start, unless it is nothing else. So no
# match reaches over a blank or line end that follows anything but white space.
_SAFE = re.compile(r"(?<=\S)(?=[ \n])")
_RUN = regex.compile(r"\p{White_Space}{%d,}" % LONG_RUN)


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _decimals(path: str, pattern: str) -> list[bytes]:
    return [b"%d" % i for i in range(encoding(path, pattern).max_token_value + 1)]


def safe_pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """``text`` cut into pieces that encode one by one to what it encodes to as a whole."""
    at = 0
    while len(text) - at > size:
        found = _SAFE.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def _matches_apart(codec: tiktoken.Encoding, text: str) -> list[int]:
    """Encode a text with very long runs of white space. Such a run is one match up to its last
    character, which is left to what follows; at the end of the text it is one match whole."""
    ids, at = [], 0
    for run in _RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += codec.encode_ordinary(text[at : run.start()])
        ids += codec._encode_single_piece(text[run.start() : end])
        at = end
    return ids + codec.encode_ordinary(text[at:])


def encode_text(codec: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a whole text, without special tokens."""
    if len(text) < LONG_RUN:
        return codec.encode_ordinary(text)
    apart = _RUN.search(text) is not None
    if not apart and len(text) <= PIECE:
        return codec.encode_ordinary(text)
    if apart:
        return _matches_apart(codec, text)
    return [i for piece in safe_pieces(text) for i in codec.encode_ordinary(piece)]


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the ``ids`` of each text, a row for a row. NULL and empty texts have no
    ids; a NULL ``doc_id`` is passed on; other columns are left behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(path, pattern)
        for batch in batches:
            for part in _slices(batch):
                ids = [encode_text(codec, value or "") for value in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    schema = StructType([StructField("doc_id", docs.schema[doc_id].dataType), StructField("ids", ArrayType(IntegerType()))])
    return cut(docs, doc_id=doc_id, text=text).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id`` and the ``bytes`` that the ids of each row stand for. They are raw: the ids of a
    piece of a text need not hold whole characters. NULL ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(path, pattern)
        for batch in batches:
            raw = [codec.decode_bytes(value or []) for value in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    schema = StructType([StructField("doc_id", encoded.schema[doc_id].dataType), StructField("bytes", BinaryType())])
    return cut(encoded, doc_id=doc_id, ids=ids).mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Few texts at a time, so that no more than their ids are in memory as Python objects."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text, and keep digests of both: ``doc_id``, ``n_tokens``,
    ``ids_sha256`` of the decimal ids joined by blanks, ``decoded_sha256`` of the decoded bytes.

    One row for each row, in one pass without a shuffle. NULL is an empty text, whose digests
    are those of nothing; NULL ids, repeated rows and further columns change nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, decimals = encoding(path, pattern), _decimals(path, pattern)
        for batch in batches:
            counts, ids_hex, raw_hex = [], [], []
            for part in _slices(batch):
                for value in part.column(1).to_pylist():
                    ids = encode_text(codec, value or "")
                    counts.append(len(ids))
                    ids_hex.append(hashlib.sha256(b" ".join([decimals[i] for i in ids])).hexdigest())
                    raw_hex.append(hashlib.sha256(codec.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(raw_hex, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = StructType([
        StructField("doc_id", docs.schema[doc_id].dataType), StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType()),
    ])
    return cut(docs, doc_id=doc_id, text=text).mapInArrow(run, schema)
