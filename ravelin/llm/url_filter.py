"""URL rules: a blocked Bloom filter of the listed prefixes, then an exact join of the possible hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.llm.common import table, temp

#: The filter takes this much at most, whatever the list's length; beyond that more false hits reach the exact join.
MAX_FILTER_BYTES = 64 << 20
BITS_PER_RULE = 16
BLOCK_WORDS = 8  # a block is 8 words of 64 bits: one cache line
#: Rules up to this many are joined by broadcast: at most a few MB, the rule texts being counted too.
BROADCAST_RULES, BROADCAST_BYTES = 50_000, 8 << 20

#: The rules of the query: verdict, host and path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, A to Z in lower case; else empty."""
    rest = F.substring_index(F.substring_index(F.substring_index(_rest(url), "/", 1), "?", 1), "#", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    rest = _rest(url)
    host = F.substring_index(F.substring_index(F.substring_index(rest, "/", 1), "?", 1), "#", 1)
    return F.substring_index(F.substring_index(F.substr(rest, F.length(host) + 1), "?", 1), "#", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def _places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash and its mask of one bit in each of the block's words."""
    unsigned = hashes.astype(np.uint64)
    at = ((unsigned >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    low = (unsigned & np.uint64(0xFFFFFFFF))[:, None] * np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393, 2246822507, 3266489909, 2654435769], dtype=np.uint64)
    return at.astype(np.int64), np.uint64(1) << ((low >> np.uint64(20)) & np.uint64(63))


def _partial_filter(blocks: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros((blocks, BLOCK_WORDS), dtype=np.uint64)
        for frame in frames:
            at, mask = _places(frame["hash"].to_numpy(), blocks)
            np.bitwise_or.at(bits, at, mask)
        used = np.flatnonzero(bits.any(axis=1))
        yield pd.DataFrame({"block": used} | {f"w{k}": bits[used, k].astype(np.int64) for k in range(BLOCK_WORDS)})

    return run


def build_filter(rules: DataFrame, count: int) -> np.ndarray:
    """The blocked Bloom filter of `count` rules' hosts and whole keys. Each task sets bits in its own copy; copies are merged by block."""
    keys = rules.select(F.explode(F.array(_key_hash(F.col("host"), F.col("path")), _host_hash(F.col("host")))).alias("hash"))
    blocks = int(np.clip(-(-2 * count * BITS_PER_RULE // (BLOCK_WORDS * 64)), 1, MAX_FILTER_BYTES // (BLOCK_WORDS * 8)))
    words = [f"w{k}" for k in range(BLOCK_WORDS)]
    partial = keys.mapInPandas(_partial_filter(blocks), "block long, " + ", ".join(f"{w} long" for w in words))
    merged = partial.groupBy("block").agg(*(F.bit_or(w).alias(w) for w in words)).toPandas()  # MAX_FILTER_BYTES at most
    bits = np.zeros((blocks, BLOCK_WORDS), dtype=np.uint64)
    bits[merged["block"].to_numpy()] = merged[words].to_numpy().astype(np.uint64)
    return bits


def _key_hash(host: Column, path: Column) -> Column:
    return F.xxhash64(host, F.lit("\n"), path)


def _host_hash(host: Column) -> Column:
    return F.xxhash64(host, F.lit("\n\n"))


def _passes(bits: np.ndarray, spark: SparkSession):
    shared = spark.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def passes(hashes: pd.Series) -> pd.Series:
        bits = shared.value
        at, mask = _places(hashes.to_numpy(), len(bits))
        return pd.Series(((bits[at] & mask) == mask).all(axis=1))

    return passes


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", unlisted: str = "allow") -> DataFrame:
    """`pages` with `host`, `path`, `rule` (null: none fits) and `verdict`.

    A rule (verdict, host, path) fits its host and all subdomains where the URL's path starts with the rule's. The
    longest host and path together win, then the longer host. Each distinct URL offers its host's suffixes; the filter,
    which holds the rules' hosts and their whole keys, drops nearly all that no rule names. The rest take their host's
    path lengths, offer the path cut at each, pass the filter again and meet the rules in an exact join; the best rule
    goes back to the pages by URL. URLs are made distinct first, so a URL that fills a third of the table is judged once.
    Where no rule fits the verdict is `unlisted`.

    Null URLs and those without :// have empty host and path and no rule; long URLs are judged whole. Repeated rules count once (block before allow);
    rules with a null part are left out; empty tables work. Columns called host, path, rule or verdict are replaced.
    """
    spark = pages.sparkSession
    pages = pages.drop("host", "path", "rule", "verdict")
    listed = rules.where("host is not null and path is not null and verdict is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    facts = listed.agg(F.count("*").alias("n"), F.sum(F.length("host") + F.length("path") + 64).alias("bytes")).first()
    key = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    host, path, whole = temp("host"), temp("path"), temp("url")
    urls = pages.select(key.alias(whole)).distinct().select(whole, host_of(F.col(whole)).alias(host), path_of(F.col(whole)).alias(path)).where(F.col(host) != "")
    if not facts["n"]:
        return pages.select("*", host_of(key).alias("host"), path_of(key).alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(unlisted).alias("verdict"))
    labels = F.split(host, "\\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    small = facts["n"] <= BROADCAST_RULES and facts["bytes"] <= BROADCAST_BYTES
    bounded = F.broadcast if small else lambda side: side
    by_host = listed.groupBy("host").agg(F.collect_set(F.length("path")).alias("cuts"))
    passes = _passes(build_filter(listed, facts["n"]), spark)
    offers = urls.select(whole, path, F.explode(suffixes).alias("host")).where(passes(_host_hash(F.col("host"))))
    offers = offers.join(bounded(by_host), "host").select(whole, "host", path, F.explode(F.filter("cuts", lambda n: n <= F.length(path))).alias("cut"))
    offers = offers.select(whole, "host", F.substr(F.col(path), F.lit(1), F.col("cut")).alias("path"))
    exact = offers.where(passes(_key_hash(F.col("host"), F.col("path")))).join(bounded(listed), ["host", "path"])
    rule = F.concat("host", "path")
    best = exact.groupBy(whole).agg(F.max_by(F.struct(rule.alias("rule"), "verdict"), F.struct(F.length(rule), F.length("host"))).alias("best"))
    return (
        pages.withColumn(whole, key)
        .join(best, whole, "left")
        .withColumns({"host": host_of(F.col(whole)), "path": path_of(F.col(whole)), "rule": F.col("best.rule"), "verdict": F.coalesce("best.verdict", F.lit(unlisted))})
        .drop(whole, "best")
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's URL under the rules."""
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return judge_urls(table(spark, folder, "pages").select("page_id", "url"), rules)


_LISTED = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
ORACLE = f"""
with rules(verdict, rule_host, rule_path) as (values {_LISTED}),
cut as (select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
parts as (
  select page_id, url, regexp_extract(rest, '^[^/?#]*') as raw, rest from cut
),
split as (
  select page_id, url, translate(coalesce(raw, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') as path
  from parts
),
fits as (
  select page_id, rule_host || rule_path as rule, verdict,
    row_number() over (partition by page_id order by length(rule_host || rule_path) desc, length(rule_host) desc) as place
  from split join rules on (host = rule_host or suffix(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select s.page_id, s.url, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from split s left join fits f on s.page_id = f.page_id and f.place = 1
"""
