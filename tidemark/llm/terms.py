"""Terms of texts: runs of ASCII letters, digits and anything beyond ASCII, A-Z in lower case."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import cut

#: UTF-8 bytes of a term once A-Z are lower-cased. All bytes of characters beyond ASCII belong.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^0-9A-Za-z\x80-\xff]")

#: Bytes of a text whose terms are in memory as Python objects at a time.
PIECE = 1 << 20

#: Rows of :func:`frequencies` that count documents with a term, all terms, and all documents.
_FILLED, _TERMS, _DOCUMENTS = -1, -2, -3


def terms(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text in order, a list for each piece of about ``size`` bytes. Pieces end
    between terms, so a longer term is whole."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > size:
            found = _BETWEEN.search(text, at + size)
            end = found.start() if found else end
        yield _TERM.findall(text[at:end].lower())
        at = end


def frequencies(docs: DataFrame, vocabulary: Collection[bytes], text: str = "text") -> tuple[int, int, int, dict[bytes, int]]:
    """Over all texts: how many have a term, how many terms they have in all, how many texts there
    are, and in how many of them each term of ``vocabulary`` is (0 where in none).

    One pass; a task sends one number for each term it met. The vocabulary, that of queries or
    templates, travels with the tasks. NULL is a text without terms."""
    names = sorted(set(vocabulary))
    number = {name: i for i, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                seen, size = set(), 0
                for piece in terms(value.as_py() or b""):
                    size += len(piece)
                    seen.update(number.keys() & piece)
                counts[_DOCUMENTS] += 1
                counts[_FILLED] += size > 0
                counts[_TERMS] += size
                counts.update(number[name] for name in seen)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

    found = cut(docs, text=text).select(F.col("text").cast("binary")).mapInArrow(run, "term int, n long")
    total = {row["term"]: row["n"] for row in found.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    held = {name: total.get(i, 0) for name, i in number.items()}
    return total.get(_FILLED, 0), total.get(_TERMS, 0), total.get(_DOCUMENTS, 0), held
