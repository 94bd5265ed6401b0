"""Ranked search, licence scans and whitening, against plain versions of what they compute."""

import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import licences, queries, ranked, registry, whitening  # noqa: F401
from tidemark.llm.licences import NOTICES, PHRASES, Template
from tidemark.llm.terms import frequencies, terms

SF_DIR = "/root/testdata/sf0.001"
CLASH = ("item", "key", "n", "places", "counts", "bound", "rank", "score", "body", "x", "whitened", "component", "hits", "label")

TEXTS = [
    (1, "Alpha beta, gamma! ALPHA"), (2, "beta beta beta"), (3, None), (4, ""), (5, " .,;\x00 "), (6, "älpha ÄLPHA alpha Älpha"),
    (7, "alpha beta gamma delta"), (7, "alpha beta gamma delta"), (8, "alpha beta gamma delta"), (None, "alpha beta"), (9, "x" * 3_000_000),
    (10, "alpha " * 5000 + "beta"), (11, "1 2 3 alpha-beta_gamma"), (12, "MIT License. mit-license, the mit; license"),
]


def clashing(df):
    return df.withColumns({name: F.lit("clash") for name in CLASH})


@pytest.fixture(scope="module")
def odd(spark):
    return clashing(spark.createDataFrame(TEXTS, "doc_id long, text string"))


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))


def brute_search(docs, items, k):
    counted = [(i, Counter(words(text))) for i, text in docs]
    n_docs = sum(1 for _, c in counted if c)
    total = sum(c.total() for _, c in counted)
    holding = Counter(term for _, c in counted for term in c)
    for item, own in items.items():
        scores = []
        for i, c in counted:
            if c:
                m = 100 - 25 + (25 * c.total() * n_docs) // total
                score = 0
                for term, times in own.items():
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[term] + 1)))
                    score += times * w * ((10**9 * c[term]) // (1000 * c[term] + 12 * m))
                if score > 0:
                    scores.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            yield item, rank, i, -score


def test_terms_come_in_pieces():
    text = "Ab,cd ä9_zz " * 50
    assert [t.decode() for piece in terms(text.encode(), 7) for t in piece] == words(text)


def test_frequencies(spark, odd):
    filled, total, rows, held = frequencies(odd, [b"alpha", b"beta", b"nowhere"])
    own = [words(text) for _, text in TEXTS]
    assert (filled, total, rows) == (sum(map(bool, own)), sum(map(len, own)), len(TEXTS))
    assert held == {b"alpha": sum("alpha" in o for o in own), b"beta": sum("beta" in o for o in own), b"nowhere": 0}


ITEMS = [(1, "alpha beta"), (1, "gamma"), (2, "Alpha ALPHA älpha"), (3, None), (4, ""), (5, "nowhere"), (6, "x" * 3_000_000), (None, "beta 1")]


@pytest.mark.parametrize("k, width, block, sent", [(3, 1 << 16, 256, 1000), (2, 2, 1, 0), (20, 1 << 16, 2, 5)])
def test_search_agrees_with_brute_force(spark, odd, monkeypatch, k, width, block, sent):
    """Two coordinates only, so that all terms collide, items in many blocks, and either way to
    meet the texts change nothing."""
    monkeypatch.setattr(ranked, "WIDTH", width)
    monkeypatch.setattr(ranked, "SENT", sent)
    monkeypatch.setattr(ranked, "ITEMS", block)
    asked = {}
    for item, text in ITEMS:
        asked.setdefault(item, Counter()).update(words(text))
    found = ranked.search(odd.repartition(5), clashing(spark.createDataFrame(ITEMS, "item_id long, text string")), k)
    assert Counter(map(tuple, found.collect())) == Counter(brute_search(TEXTS, asked, k))


def test_search_of_documents(spark):
    docs, items = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    asked = {r["item_id"]: Counter(words(r["text"])) for r in items.collect()}
    found = registry.QUERIES["op11_ranked_search"](spark, SF_DIR)
    assert Counter(map(tuple, found.collect())) == Counter(brute_search(plain, asked, 20))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]


def test_search_in_empty_tables(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked.search(odd.limit(0), items).count() == ranked.search(odd, items.limit(0)).count() == 0


def brute_phrases(text):
    own, found = words(text), []
    for label, phrase in (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")):
        own_phrase = phrase.split()
        found += [(i, label) for i in range(len(own)) if own[i : i + len(own_phrase)] == own_phrase]
    starts = [i for i, _ in found]
    return len(own), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in found}))


def test_base_of_licences_agrees_with_brute_force(spark, odd):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for table, found in ((docs, registry.QUERIES["op12_license_scan"](spark, SF_DIR)), (odd, licences.summary(licences.scan(odd, (*PHRASES, *NOTICES)), len(PHRASES)))):
        rows = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found.collect())
        assert rows == Counter((r["doc_id"], *brute_phrases(r["text"])) for r in table.collect())
        assert found.where("score NOT BETWEEN 0 AND 1 OR (n_base > 0 AND score < 1)").count() == 0
        assert found.where("NOT array_contains(split(labels, ','), 'mit') AND array_contains(split(base_labels, ','), 'mit')").count() == 0


def test_licences_in_files(spark):
    grant = next(t for t in NOTICES if t.label == "mit" and t.keys).text
    apache = next(t for t in NOTICES if t.label == "apache-2.0" and t.keys).text
    texts = {
        1: f"# Copyright someone\n{grant}\ncode code", 2: grant.replace("copy, modify, ", "").upper(), 3: grant.replace("free of charge", "for a fee"),
        4: f"// {apache}", 5: "permission is hereby granted free of charge " * 3, 6: "the mit license " * 40_000, 7: "GNU Lesser General Public License",
        8: "mit mit license license general public general public license apache\nlicense", 9: "Licensed under CC BY-NC 4.0.",
    }
    rows = {r["doc_id"]: r for r in licences.summary(licences.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), (*PHRASES, *NOTICES)), 3).collect()}
    labels = {i: r["labels"] for i, r in rows.items()}
    assert labels == {1: "mit", 2: "mit", 3: "", 4: "apache,apache-2.0", 5: "", 6: "mit", 7: "gpl,lgpl", 8: "apache,gpl,mit", 9: "cc-by-nc"}
    assert rows[1]["n_base"] == 0 and rows[1]["score"] == 1 > rows[2]["score"] > 0.7 and rows[3]["score"] == 0
    assert (rows[6]["n_base"], rows[6]["first_word"], rows[6]["last_word"]) == (40_000, 1, 3 * 39_999 + 1)


def test_templates_state_their_phrases():
    assert all(t.phrases and t.words for t in (*PHRASES, *NOTICES))
    with pytest.raises(ValueError):
        Template("x", "some text", ("other phrase",)).phrases


def test_licences_of_an_empty_table(spark, odd):
    assert licences.summary(licences.scan(odd.limit(0), PHRASES), 3).count() == 0


def plain_whitening(rows, k=4):
    """From numpy's symmetric eigenvectors, in doubles."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    distinct = np.array(sorted({tuple(x) for _, x in kept}), dtype=object)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct.astype(float) - sums.astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    for i, x in kept:
        y = n * np.array(x, dtype=object) - sums
        yield i, n, int((y**2).sum()), (y.astype(float) / n @ vectors[:, order]) / np.sqrt(values[order]), values[order] / values.sum()


def check_whitening(found, expected):
    rows = {}
    for r in found.collect():
        rows.setdefault(r["vec_id"], []).append(r)
    for i, n, deviation, whitened, explained in expected:
        own = sorted(rows[i], key=lambda r: r["component"])
        assert [r["component"] for r in own[:4]] == list(range(1, 5)) or len(whitened) < 4
        assert {(r["n"], r["deviation"]) for r in own} == {(n, deviation)}
        assert np.allclose(np.abs([r["whitened"] for r in own]), np.abs(whitened), rtol=1e-6, atol=1e-9)
        assert np.allclose([r["explained"] for r in own], explained, rtol=1e-9) and all(r["identity_error"] < 1e-9 for r in own)


def test_whitening_of_embeddings(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    check_whitening(registry.QUERIES["op13_embedding_whitening"](spark, SF_DIR), plain_whitening(rows))


def test_whitening_of_odd_rows(spark):
    random = np.random.default_rng(5)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(random.normal(size=(40, 6)) * [1, 2, 3, 4, 5, 1e-9])]
    rows += [(50, rows[0][1]), (None, rows[1][1]), (51, None), (52, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (53, [float("nan")] * 6), (54, [float("inf")] * 6), (55, [])]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = whitening.whiten(df)
    check_whitening(found, plain_whitening([row for row in rows if row[0] is not None]))
    assert found.where("vec_id IS NULL").count() == 4 and found.count() == 42 * 4
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id IN (0, 50)")).count() == 0  # one distinct vector varies in nothing
    assert whitening.whiten(df.where("vec_id < 2")).count() == 2  # two have one component
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>"))


def test_whitening_of_large_and_equal_entries(spark):
    """Entries whose squares no double holds, and equal eigenvalues."""
    rows = [(0, [2.0**45, 0.0, 0.0]), (1, [-(2.0**45), 0.0, 0.0]), (2, [0.0, 2.0**45, 0.0]), (3, [0.0, -(2.0**45), 0.0]), (4, [0.0, 0.0, 1.0]), (5, [0.0, 0.0, -1.0])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in found} == {1, 2, 3} and all(r["deviation"] is None for r in found if r["vec_id"] < 4)
    assert all(r["identity_error"] < 1e-9 and r["n"] == 6 for r in found)
    assert {r["deviation"] for r in found if r["vec_id"] > 3} == {(6 * 256) ** 2}


def test_products_are_exact():
    x = np.array([[2**62, -(2**61) + 3, 7], [-(2**63), 2**40 + 1, -1], [5, 2**21, -(2**21) - 1]])
    assert (whitening.products(x) == x.astype(object).T @ x.astype(object)).all()


def test_polynomial_and_roots(spark):
    random = np.random.default_rng(1)
    a = random.integers(-9, 9, (7, 7))
    m = (a @ a.T).astype(object)
    polynomial = whitening.characteristic(spark, m)
    powers, c = np.eye(7, dtype=object).astype(object), [0] * 7 + [1]
    for k in range(1, 8):  # Faddeev-LeVerrier, in fractions
        powers = m @ (powers if k == 1 else powers)
        c[7 - k] = Fraction(-int(np.trace(powers)), k)
        powers = powers + np.diag([int(c[7 - k])] * 7).astype(object)
    assert polynomial == c
    values = np.sort(np.linalg.eigvalsh(m.astype(float)))[::-1]
    for i in range(4):
        high, power = whitening.root(polynomial, i + 1, int(np.trace(m)))
        assert high / (1 << power) == pytest.approx(values[i], rel=1e-9)
    assert whitening.root([0, 0, 4, -4, 1], 1, 10) == whitening.root([0, 0, 4, -4, 1], 2, 10)  # t^2 (t - 2)^2
    assert whitening.root([0, 0, 4, -4, 1], 3, 10) is None
