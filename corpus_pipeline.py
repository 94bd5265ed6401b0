"""A corpus from documents to packed sequences: five stages, each a table written and read."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import curate, packing, toxicity
from tidemark.llm.frames import load, noting, settled
from tidemark.llm.labelled import fold
from tidemark.llm.registry import ship
from tidemark.sources.files import discard

#: SQL cannot state the stages; tests compare each with a plain version of it.
ORACLE_SQL = None


#: Tables that a stage has left, of stages that are called one by one, by the folder of the tables
#: they work on. Such a caller writes a stage's rows before calling the next one, so that one's
#: call says that they are done with. :func:`run` has no part in this.
_left: dict[str, list[str]] = {}


def stage(function):
    """Ship the code, clear away what the stage before has left, and note what this one leaves."""

    @functools.wraps(function)
    def called(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        own = _left.setdefault(sf_dir, [])
        while own:
            discard(spark, own.pop())
        with noting(own):
            return function(spark, docs, sf_dir)

    return called


@stage
def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject."""
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"), "toxic", fold("doc_id", 4) != 2)
    return toxicity.accept(docs, model, threshold=0.3)


@stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal ones."""
    return curate.without_copies(docs)


@stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return curate.without_near_copies(docs)


@stage
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what recurs from earlier documents."""
    return curate.without_repeats(docs)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, packed."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, capacity=2048)


STAGES = [("toxicity", clean), ("exact_dedup", exact), ("minhash_near_dedup", near), ("suffix_dedup", substrings), ("best_fit_packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage keeps is written for the next.

    Each run owns its tables: those of a stage, and the rows it was given, are deleted as soon as
    what it keeps is written, also where it fails. Only the last stage's rows are left, which the
    result reads and no other run touches; they go when the application ends."""
    ship(spark)
    docs, given = load(spark, sf_dir, "documents"), []
    for name, function in STAGES:
        written: list[str] = []
        try:
            with noting(written):
                docs = settled(spark, name, lambda function=function, docs=docs: function.__wrapped__(spark, docs, sf_dir))
        except BaseException:
            given += written
            raise
        finally:
            for path in given:
                discard(spark, path)
        given = written
    return docs
