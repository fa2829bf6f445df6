"""URL rules behind a blocked Bloom filter, in DataFrame functions only.

Rules are canonical URLs: a host, a path and a verdict. A rule fits its host and all
subdomains when the url's path starts with the rule's path; of several that fit, the
longest wins. Every url is expanded into the keys a fitting rule could have (each
suffix of its host with each of its path's prefixes of a listed length). The filter
lets through the keys that may be listed, and an exact join with the rules removes
its false positives.

The filter has blocks of eight 64-bit words; a key sets one bit in each word of one
block, so that a test touches one cache line. Its size follows the number of rules
and stops at ``MAX_WORDS``; beyond, more false positives reach the join and the
result stays the same.

Defined results: a null url or one without ``://`` has an empty host and path and is
judged by no rule. Repeated pages each get their row. Hosts are taken literally, so a
port or user name is part of the host. No rules: every url gets the default.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_WORDS = 8
BITS_PER_KEY = 32
MAX_WORDS = 1 << 17  # 1 MB


def url_host(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: str | Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _word_and_bit(key: Column, blocks: Column | int) -> list[tuple[Column, Column]]:
    """Index of the word and number of the bit, for each word of the key's block."""
    blocks = F.lit(blocks) if isinstance(blocks, int) else blocks
    block = F.pmod(F.xxhash64(key), blocks)
    bits = F.xxhash64(key, F.lit(1))
    return [
        (
            (block * BLOCK_WORDS + j).cast("int"),
            F.shiftrightunsigned(bits, 6 * j).bitwiseAND(F.lit(63)).cast("int"),
        )
        for j in range(BLOCK_WORDS)
    ]


def filter_blocks(n_rules: int) -> int:
    wanted = -(-max(n_rules, 1) * BITS_PER_KEY // (64 * BLOCK_WORDS))
    return min(wanted, MAX_WORDS // BLOCK_WORDS)


def build_filter(rules: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row with the filter's words as an array of ``blocks * 8`` longs."""
    pairs = [F.struct(w.alias("word"), b.alias("bit")) for w, b in _word_and_bit(F.col(key), blocks)]
    one = F.expr("shiftleft(1L, bit)")
    words = (
        rules.select(F.inline(F.array(*pairs)))
        .groupBy("word")
        .agg(F.bit_or(one).alias("bits"))
    )
    every = rules.sparkSession.range(blocks * BLOCK_WORDS).select(F.col("id").cast("int").alias("word"))
    full = every.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return full.agg(F.transform(ordered, lambda x: x["bits"]).alias("words"))


def may_contain(words: Column, key: Column, blocks: int) -> Column:
    """Whether the key may be in the filter; never false for a key that is."""
    tests = [
        F.call_function("shiftrightunsigned", F.get(words, word), bit).bitwiseAND(F.lit(1)) == 1
        for word, bit in _word_and_bit(key, blocks)
    ]
    return reduce(lambda a, b: a & b, tests)


def candidate_keys(host: Column, path: Column, lengths: Column) -> Column:
    """Keys of all rules that could fit: host suffixes with path prefixes."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n)
    )
    pair = lambda s: F.transform(
        prefixes, lambda p: F.struct(s.alias("rule_host"), p.alias("rule_path"))
    )
    return F.flatten(F.transform(suffixes, pair))


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``; the same host and path given
    twice with different verdicts count as the alphabetically first.
    """
    clash = {"host", "path", "rule", "verdict"} & set(pages.columns)
    if clash:
        raise ValueError(f"pages already have columns {sorted(clash)}")
    rules = (
        rules.select(
            F.translate("host", UPPER, LOWER).alias("rule_host"),
            F.coalesce("path", F.lit("")).alias("rule_path"),
            F.col("verdict").alias("rule_verdict"),
        )
        .where(F.col("rule_host").isNotNull())
        .groupBy("rule_host", "rule_path")
        .agg(F.min("rule_verdict").alias("rule_verdict"))
        .withColumn("rule_key", F.concat("rule_host", "rule_path"))
    )
    blocks = filter_blocks(rules.count())
    words = build_filter(rules, "rule_key", blocks).scalar()
    lengths = rules.agg(F.sort_array(F.collect_set(F.length("rule_path")))).scalar()

    placed = pages.withColumn("host", F.coalesce(url_host(url), F.lit(""))).withColumn(
        "path", F.coalesce(url_path(url), F.lit(""))
    )
    # The verdict depends on host and path alone, so each pair is judged once.
    urls = placed.select("host", "path").distinct().withColumn("lengths", lengths)
    keys = urls.select(
        "host",
        "path",
        F.inline(candidate_keys(F.col("host"), F.col("path"), F.col("lengths"))),
    )
    key = F.concat("rule_host", "rule_path")
    possible = keys.where(may_contain(words, key, blocks))
    fitting = possible.join(rules, ["rule_host", "rule_path"])
    order = F.struct(F.length("rule_key"), F.length("rule_host"))
    judged = fitting.groupBy("host", "path").agg(
        F.max_by("rule_key", order).alias("rule"), F.max_by("rule_verdict", order).alias("verdict")
    )
    return placed.join(judged, ["host", "path"], "left").select(
        *pages.columns,
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
