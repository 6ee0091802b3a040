"""Operator 10 (native): exact URL verdicts from a cascade of Bloom filters."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mishap.llm.common import store, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the query (action, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))

MAX_KEYS = 1_000_000
"""Bound on the rule list, which is broadcast once to build the cascade; the cascade itself
takes a few bytes a rule, whatever the corpus."""


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its number of bits and hashes, and its bits as 64-bit words."""
    bits: int
    hashes: int
    words: tuple[int, ...]


def _spots(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits)) for j in range(hashes)]


def _build(keys: DataFrame, level: int, rate: float) -> Level:
    """The filter of ``keys.key`` with this rate of false positives: one aggregation of words."""
    n = max(1, keys.count())
    bits = 64 * math.ceil(max(64, n * math.log(1 / rate) / math.log(2) ** 2) / 64)
    hashes = max(1, round(bits / n * math.log(2))) if n > 8 else 7
    hashes = min(hashes, 20)
    spots = keys.select(F.explode(F.array(*_spots(F.col("key"), level, bits, hashes))).alias("at"))
    rows = (spots.groupBy(F.floor(F.col("at") / 64).cast("int").alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("mask")).collect())
    words = [0] * (bits // 64)
    for r in rows:
        words[r["word"]] = r["mask"]
    return Level(bits, hashes, tuple(words))


def _passes(key: Column, number: int, level: Level) -> Column:
    words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<bigint>")
    hit = F.lit(True)
    for at in _spots(key, number, level.bits, level.hashes):
        word = F.element_at(words, (F.floor(at / 64) + 1).cast("int"))
        hit = hit & (F.getbit(word, (at % 64).cast("int")) == 1)
    return hit


def build_cascade(listed: Sequence[str], universe: DataFrame) -> list[Level]:
    """Filters that together answer membership in ``listed`` exactly for every key of ``universe``.

    Level 1 holds the listed keys, level 2 the universe's other keys that pass
    level 1, level 3 the listed keys that pass level 2, and so on until no key
    passes wrongly.  Level 1's rate follows the two counts and the others
    halve the rest, so all levels together take a few bits a listed key.
    """
    if len(listed) > MAX_KEYS:
        raise ValueError(f"{len(listed)} listed keys; the bound is {MAX_KEYS}")
    include = universe.sparkSession.range(1).select(
        F.explode(F.from_json(F.lit(json.dumps(sorted(set(listed)))), "array<string>")).alias("key"))
    exclude = universe.select("key").filter("key is not null").join(F.broadcast(include), "key", "left_anti")
    others, levels = exclude.count(), []
    rate = min(0.5, max(len(listed), 1) * math.sqrt(0.5) / max(others, 1))
    while listed and len(levels) < 64:
        number = len(levels)
        levels.append(_build(include, number, rate if not levels else 0.5))
        wrong = store(exclude.filter(_passes(F.col("key"), number, levels[-1])), "cascade-level")
        if wrong.isEmpty():
            return levels
        include, exclude = wrong, include
    if listed:
        raise RuntimeError("the cascade did not end; keys that no hash tells apart")
    return levels


def member(key: Column, levels: Sequence[Level]) -> Column:
    """Whether a key of the universe is listed: the first level that it fails decides."""
    answer = F.lit(len(levels) % 2 == 1)
    for number in range(len(levels) - 1, -1, -1):
        answer = F.when(~_passes(key, number, levels[number]), F.lit(number % 2 == 1)).otherwise(answer)
    return answer


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty if it is null or has no ``://``."""
    form = "(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, form, k), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def _keys(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The keys a URL may be listed under: action, host suffix and path prefix of the rules' lengths."""
    labels = F.split(host, r"\.", -1)
    keys = []
    for count in sorted({h.count(".") + 1 for _, h, _ in rules}):
        suffix = F.array_join(F.slice(labels, -count, count), ".")
        for length in sorted({len(p) for _, _, p in rules}):
            for action in ("allow", "block"):
                keys.append(F.when((F.size(labels) >= count) & (F.length(path) >= length),
                                   F.concat(F.lit(action + " "), suffix, F.substring(path, 1, length))))
    return F.array_compact(F.array(*keys))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url",
               default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to every row.

    Only the rules' keys are listed; the corpus's key universe (each URL's host
    suffixes and path prefixes, once) makes the cascade exact for its own URLs,
    so the verdict is an expression on the row: no join.  The longest rule that
    fits wins; a URL that none fits is not listed and gets ``default``.

    Null or odd URLs have an empty host and path and get the default; repeated
    rows are judged alike; an empty table gives no rows.  Columns of the input
    named host, path, rule or verdict are replaced.
    """
    if not rules:
        host, path = url_parts(F.col(url))
        return pages.withColumns({"host": host, "path": path, "rule": F.lit(None).cast("string"),
                                  "verdict": F.lit(default)})
    host, path = url_parts(F.col(url))
    listed = sorted({f"{a} {h}{p}" for a, h, p in rules})
    universe = store(pages.select(F.explode(_keys(host, path, rules)).alias("key")).distinct(), "url-keys")
    levels = build_cascade(listed, universe)
    parts = pages.withColumns({"host": host, "path": path})
    fits = F.filter(_keys(F.col("host"), F.col("path"), rules), lambda k: member(k, levels))
    best = F.array_max(F.transform(fits, lambda k: F.struct(F.length(k).alias("size"), k.alias("key"))))
    return (parts.withColumn("rule", best["key"])
            .withColumn("verdict", F.coalesce(F.substring_index("rule", " ", 1), F.lit(default)))
            .withColumn("rule", F.expr("substring(rule, instr(rule, ' ') + 1)")))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH u AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(action, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT page_id, host, path, rhost || rpath AS rule, action
  FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, max_by(rule, length(rule)) AS rule,
       coalesce(max_by(action, length(rule)), 'allow') AS verdict
FROM fit GROUP BY page_id, host, path
"""
