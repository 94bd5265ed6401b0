"""URL lists: a blocked Bloom filter before an exact hash join, all in Spark's expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import cut

#: Most 64-bit words of the filter, 1 MiB: what is broadcast never exceeds it. A longer list
#: only has more false positives, which the join removes.
MAX_WORDS = 1 << 17
#: Words for each listed entry, and bits set in a word for each.
WORDS_PER_ENTRY, BITS = 0.25, 4

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def canonical(url: Column) -> tuple[Column, Column]:
    """Host and path: the host after the first ``://`` up to ``/ ? #``, A-Z in lower case; the
    path from there up to ``? #``. Both are empty without ``://`` and for NULL."""
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def _place(words: int, *key: Column) -> tuple[Column, Column]:
    """The word of the filter that a key of some columns belongs to, and its bits there."""
    other = F.xxhash64(F.lit(1), *key)
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        shift = F.shiftrightunsigned(other, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), shift))
    return F.pmod(F.xxhash64(*key), F.lit(words)).cast("int"), mask


def bloom(listed: DataFrame, words: int, *columns: str) -> DataFrame:
    """One row with the filter of some columns: an array of ``words`` longs. Each entry sets all
    its bits in one word, so a look-up touches one place in memory."""
    spark = listed.sparkSession
    word, mask = _place(words, *map(F.col, columns))
    empty = spark.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("mask"))
    filled = listed.select(word.alias("word"), mask.alias("mask")).union(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    return filled.agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).getField("mask").alias("filter"))


class _Filter:
    """A filter as a literal: at most ``MAX_WORDS`` longs, whatever the list's length."""

    def __init__(self, listed: DataFrame, words: int, *columns: str) -> None:
        self.words = words
        self.held = F.lit(np.array(bloom(listed, words, *columns).first()["filter"], dtype=np.int64))

    def may_hold(self, *key: Column) -> Column:
        word, mask = _place(self.words, *key)
        return F.get(self.held, word).bitwiseAND(mask) == mask


def filter_urls(pages: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url",
                default: str = "allow", words: int | None = None) -> DataFrame:
    """Judge every URL by the longest listed entry that fits it.

    ``listed`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``). An entry fits its
    host, in whatever case it is listed, and all subdomains where the URL's path starts with the
    entry's. Of entries of one length the longer host wins; an entry listed with both verdicts
    blocks; entries with a NULL take no part. Returns ``page_id, host, path, rule, verdict``, a row
    for each row, also where rows repeat; ``rule`` is NULL and ``verdict`` the default where nothing
    fits, as for NULL URLs and an empty list. Other columns are left behind, whatever their names.

    A URL's candidates are its own: the suffixes of its host that may be listed, each with those
    prefixes of its path that have the length of a listed path. There are as many as the URL is
    long, whatever the list holds, and two filters rule nearly all of them out: one of hosts, one of
    entries. URLs without a possible hit are done then and are not shuffled; the candidates of the
    rest meet the list in a hash join. No join is forced to broadcast. The filters and the lengths
    of listed paths are all that comes to the driver."""
    host, path = F.translate("host", _UPPER, _UPPER.lower()).alias("rule_host"), F.col("path").alias("rule_path")
    entries = (
        cut(listed, host="host", path="path", verdict="verdict").dropna()
        .select(host, path, "verdict").groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    )
    lengths, count = entries.agg(F.sort_array(F.collect_set(F.length("rule_path"))), F.count(F.lit(1))).first()
    host, path = canonical(F.col("url"))
    parsed = cut(pages, page_id=page_id, url=url).select("page_id", host.alias("host"), path.alias("path"))
    nothing = F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
    if not count:
        return parsed.select("*", *nothing)
    if words is None:
        words = min(MAX_WORDS, max(64, int(WORDS_PER_ENTRY * count) + 1))
    hosts, rules = _Filter(entries.select("rule_host").distinct(), words, "rule_host"), _Filter(entries, words, "rule_host", "rule_path")

    labels = F.sequence(F.lit(1), F.size(F.split("host", r"\.")))
    own = F.filter(F.transform(labels, lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n)), lambda suffix: hosts.may_hold(suffix))
    known = F.lit(np.array(lengths, dtype=np.int32))
    fitting = F.filter(known, lambda n: n <= F.length("path"))

    def candidates(suffix: Column) -> Column:
        prefixes = F.transform("prefixes", lambda prefix: F.struct(suffix.alias("rule_host"), prefix.alias("rule_path")))
        return F.filter(prefixes, lambda one: rules.may_hold(one["rule_host"], one["rule_path"]))

    probed = (
        parsed.withColumn("hosts", own)
        # Only where a host may be listed are there prefixes to look at.
        .withColumn("prefixes", F.when(F.size("hosts") > 0, F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))))
        .select("page_id", "host", "path", F.flatten(F.transform("hosts", candidates)).alias("hits"))
    )
    clear = probed.where(F.size("hits") == 0).select("page_id", "host", "path", *nothing)
    hits = probed.where(F.size("hits") > 0).select("page_id", "host", "path", F.size("hits").alias("each"), F.inline("hits"))
    joined = hits.join(entries, ["rule_host", "rule_path"], "left").withColumn("listed", F.col("verdict").isNotNull())
    rule = F.concat("rule_host", "rule_path")
    best = F.max_by(
        F.struct(F.when(F.col("listed"), rule).alias("rule"), "verdict"),
        F.struct("listed", F.length(rule), F.length("rule_host")),
    )
    # Rows of one page are told apart by what they hold; copies are counted, then given back.
    judged = joined.groupBy("page_id", "host", "path").agg(best.alias("best"), F.count(F.lit(1)).alias("rows"), F.max("each").alias("each"))
    again = judged.select(
        "page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), (F.col("rows") / F.col("each")).cast("int"))).alias("copy"),
    ).drop("copy")
    return clear.unionByName(again)
