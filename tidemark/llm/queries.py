"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import licences, neardup, neighbours, packing, phrases, quality, ranked, streams, suffixes, tokens, toxicity, urls, whitening
from tidemark.llm.frames import load
from tidemark.llm.labelled import fold, judged
from tidemark.llm.registry import query

#: Rules on hosts and paths that op1 judges pages by.
RULES = """VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')"""


@query("op1_url_filter", sql=f"""
    WITH p AS (
        SELECT page_id,
               coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ), r(rule_host, rule_path, verdict) AS ({RULES})
    SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
    FROM (
        SELECT page_id, host, path, (
            SELECT max_by(struct_pack(rule := rule_host || rule_path, verdict := verdict), length(rule_host || rule_path))
            FROM r WHERE (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
        ) AS best
        FROM p
    )
""")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM {RULES} AS rules(host, path, verdict)")
    return urls.filter_urls(load(spark, sf_dir, "pages"), rules)


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return tokens.digests(load(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = quality.fit(docs, load(spark, sf_dir, "labels"), "quality", fold("doc_id", 5) != 0)
    return judged(quality.score(docs, model), fold("doc_id", 5) == 0, threshold=0.3)


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"), "toxic", fold("doc_id", 4) != 2)
    return judged(toxicity.score(docs, model), fold("doc_id", 4) == 2, threshold=0.3)


@query("op6_nearest_neighbours", settle=True)
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, factor=1.0)


@query("op4_exact_dedup", settle=True, sql=r"""
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents
    )
    SELECT doc_id, first(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size,
           doc_id = first(doc_id) OVER g AS kept, sha256(bare) AS text_sha256
    FROM d WINDOW g AS (PARTITION BY bare ORDER BY n DESC, doc_id)
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.deduplicate(load(spark, sf_dir, "documents"))


@query("op7_best_fit_packing", settle=True)
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(load(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN, capacity=2048)


@query("op3_suffix_dedup", settle=True)
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(load(spark, sf_dir, "documents"))


@query("op10_phrase_automata", settle=True)
def op10_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_passages(load(spark, sf_dir, "documents"))


@query("op9_minhash_neardup", settle=True)
def op9_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(load(spark, sf_dir, "documents"))


@query("op11_ranked_search", sql=r"""
    WITH d AS (
        SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), sizes AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
    corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
    tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
    asked AS (
        SELECT item_id, term, count(*) AS times
        FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark)
        GROUP BY item_id, term
    ),
    weights AS (
        SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM tf, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term, n_docs
    ),
    scored AS (
        SELECT item_id, doc_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
        FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (r), corpus GROUP BY item_id, doc_id, r
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    WHERE rank <= 20
""")
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), k=20)


@query("op12_license_scan")
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = (*licences.PHRASES, *licences.NOTICES)
    return licences.summary(licences.scan(load(spark, sf_dir, "documents"), templates), base=len(licences.PHRASES))


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load(spark, sf_dir, "embeddings"), most=4)
