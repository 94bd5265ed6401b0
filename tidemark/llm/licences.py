"""Licences in texts: the rarest licence words of a file look up where templates may stand."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import cut
from tidemark.llm.terms import frequencies, terms


@dataclass(frozen=True)
class Template:
    """A text that stands for a licence, and what of it must be there."""

    label: str
    text: str
    #: Phrases of the text whose words must stand consecutively, near their places. Without any,
    #: the whole text is one.
    keys: tuple[str, ...] = ()
    #: Least share of the text's words, weighted by rarity, that must stand near their places.
    least: float = 0.7

    @cached_property
    def words(self) -> list[bytes]:
        return _words(self.text)

    @cached_property
    def phrases(self) -> list[tuple[int, list[bytes]]]:
        """Place within the template and words of each mandatory phrase."""
        if not self.keys:
            return [(0, self.words)]
        found = []
        for key in self.keys:
            own = _words(key)
            at = next((i for i in range(len(self.words)) if self.words[i : i + len(own)] == own), None)
            if at is None:
                raise ValueError(f"{key!r} is not in the text of {self.label!r}")
            found.append((at, own))
        return found

    @property
    def exact(self) -> bool:
        return not self.keys


def _words(text: str) -> list[bytes]:
    return [word for piece in terms(text.encode()) for word in piece]


# Phrases with their labels.
PHRASES = (
    Template("mit", "mit license"),
    Template("apache", "apache license"),
    Template("gpl", "general public license"),
)

# Names, notices and grants of public licences, with labels of their own.
NOTICES = (
    Template("apache-2.0", "apache license version 2 0"),
    Template("gpl-2.0", "general public license version 2"),
    Template("gpl-3.0", "general public license version 3"),
    Template("lgpl", "lesser general public license"),
    Template("agpl", "affero general public license"),
    Template("mpl-2.0", "mozilla public license version 2 0"),
    Template("epl", "eclipse public license"),
    Template("bsd", "bsd license"),
    Template("isc", "isc license"),
    Template("cc-by", "cc by 4 0"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc0", "cc0 1 0 universal"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        ("for any purpose with or without fee",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        ("apache license", "except in compliance with the license"),
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        ("under the terms of the gnu", "free software foundation"),
    ),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        ("this source code form is subject to the terms",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
        ("free and unencumbered software", "public domain"),
    ),
    Template(
        "cc",
        "This work is licensed under a Creative Commons Attribution International License.",
        ("creative commons attribution",),
    ),
)


class Index:
    """Where each word stands in the templates, and how rare it is in the corpus."""

    def __init__(self, templates: Sequence[Template], rarity: dict[bytes, float]) -> None:
        self.templates, self.rarity = templates, rarity
        #: Word -> (template, phrase of it, place within the phrase), for mandatory phrases.
        self.postings: dict[bytes, list[tuple[int, int, int]]] = defaultdict(list)
        for t, template in enumerate(templates):
            for p, (_, own) in enumerate(template.phrases):
                for at, word in enumerate(own):
                    self.postings[word].append((t, p, at))
        self.weights = [sum(rarity[word] for word in template.words) for template in templates]

    def places(self, text: bytes) -> tuple[int, dict[bytes, list[int]]]:
        """Number of words of a text, and the places of its licence words, ascending."""
        found: dict[bytes, list[int]] = defaultdict(list)
        size, known = 0, self.rarity.keys()
        for piece in terms(text):
            if not known.isdisjoint(piece):
                for i, word in enumerate(piece, size):
                    if word in known:
                        found[word].append(i)
            size += len(piece)
        return size, found

    def phrases(self, found: dict[bytes, list[int]]) -> dict[tuple[int, int], list[int]]:
        """Starts of the mandatory phrases of each template, ascending.

        The file's licence words are taken by falling rarity. The first one of a phrase proposes
        its starts; every further one leaves those that it confirms at its own place. A phrase that
        lacks a word is out at once."""
        starts: dict[tuple[int, int], set[int]] = {}
        left = {(t, p): len(own) for t, template in enumerate(self.templates) for p, (_, own) in enumerate(template.phrases)}
        for word in sorted(found, key=lambda word: (-self.rarity[word], word)):
            for t, p, at in self.postings.get(word, ()):
                own = (t, p)
                if own in starts:
                    if starts[own]:
                        here = found[word]
                        starts[own] = {s for s in starts[own] if _holds(here, s + at)}
                else:
                    starts[own] = {place - at for place in found[word]}
                left[own] -= 1
        return {own: sorted(s for s in some if s >= 0) for own, some in starts.items() if not left[own] and some}

    def hits(self, found: dict[bytes, list[int]]) -> Iterator[tuple[int, int, float]]:
        """Template, first word and share of every place where a template stands."""
        phrases = self.phrases(found)
        for t, template in enumerate(self.templates):
            if template.exact:
                for start in phrases.get((t, 0), ()):
                    yield t, start, 1.0
                continue
            # Words may have come in or gone: a quarter of the text, eight words at least.
            slack = max(8, len(template.words) // 4)
            if any((t, p) not in phrases for p in range(len(template.phrases))):
                continue
            first = template.phrases[0][0]
            for place in phrases[t, 0]:
                start = place - first
                if all(_near(phrases[t, p], start + at, slack) for p, (at, _) in enumerate(template.phrases)):
                    there = sum(self.rarity[word] for at, word in enumerate(template.words) if _near(found.get(word, ()), start + at, slack))
                    share = there / self.weights[t]
                    if share >= template.least:
                        yield t, max(start, 0), min(share, 1.0)


def _holds(places: list[int], at: int) -> bool:
    i = bisect_left(places, at)
    return i < len(places) and places[i] == at


def _near(places: Sequence[int], at: int, slack: int) -> bool:
    i = bisect_left(places, at - slack)
    return i < len(places) and places[i] <= at + slack


def scan(docs: DataFrame, templates: Sequence[Template], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Licences of every document: ``doc_id``, ``n_words``, and ``hits``, an array of ``template``
    (its number), ``label``, ``place`` (number of its first word) and ``score``, a hit for every
    place where a template stands.

    A first pass counts, over all documents, in how many each word of the templates is. In the
    second a file's licence words are looked up in the templates by falling rarity, their postings
    are intersected by relative position, and the mandatory phrases verified; the score is the
    share of a template's words, weighted by rarity, that stand near their places, 1 for a phrase.
    No word or place is left out, however common or many.

    A row for each row, without a shuffle of texts. NULL and empty texts have no words and no hits;
    NULL ids, repeated rows and other columns, whatever their names, change nothing. Long texts
    are read in pieces and only places of licence words are kept. Hits are ordered by template,
    then place. The templates are parameters of the job and travel with its tasks."""
    vocabulary = {word for template in templates for word in template.words}
    _, _, rows, holding = frequencies(docs, vocabulary, text)
    index = Index(templates, {word: math.log((rows + 2) / (n + 1)) for word, n in holding.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, hits = [], []
            for value in batch.column(1):
                size, found = index.places(value.as_py() or b"")
                sizes.append(size)
                hits.append([{"template": t, "label": templates[t].label, "place": place, "score": score} for t, place, score in index.hits(found)] if found else [])
            kind = pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("place", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(hits, kind)], ["doc_id", "n_words", "hits"])

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_words long, hits array<struct<template: int, label: string, place: long, score: double>>"
    return cut(docs, doc_id=doc_id, text=text).select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def summary(found: DataFrame, base: int) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of what
    :func:`scan` found; the first ``base`` templates are the base. Labels are distinct, sorted and
    joined by commas, and none are an empty text; first and last word are NULL without a base hit."""
    own = F.filter("hits", lambda hit: hit["template"] < base)
    joined = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda hit: hit["label"]))), ",")
    places = F.transform("base", lambda hit: hit["place"])
    return found.withColumn("base", own).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        joined(F.col("base")).alias("base_labels"), joined(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda hit: hit["score"])), F.lit(0.0)).alias("score"),
    )
