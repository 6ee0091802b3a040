"""Operator 2: Merkle fixity audit of replicated record archives."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mishap.llm.common import store, table, with_positions

RANGE_BYTES = 64 * 1024
"""Bytes of the archive under one leaf range (a record belongs to the range it begins in)."""
FANOUT = 16
VOLUME_BYTES = 256 * 1024 * 1024


def warc_record(url: Column, html: Column) -> Column:
    """One response record: header lines, a blank line, the payload, two line ends."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"),
                    F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
            carry: dict[str, Column] | None = None) -> DataFrame:
    """The manifest of the archive that holds every page as a record, in key order.

    Returns key, volume, offset (bytes before the record), length and the
    record's SHA-256, and the ``carry`` expressions on the page.  Only these leave
    the scan; offsets come from global prefix sums.  Null keys come first, equal keys are ordered by digest,
    repeated rows are records of their own, null urls and pages are empty.
    """
    record = warc_record(F.col(url), F.col(html))
    slim = store(pages.select(F.col(key), F.octet_length(record).cast("long").alias("length"),
                              F.sha2(record.cast("binary"), 256).alias("digest"),
                              *[c.alias(n) for n, c in (carry or {}).items()]), "warc-records")
    placed, _, _ = with_positions(slim, [key, "digest"], "length", "warc-order")
    return placed.select(key, F.floor(F.col("before") / VOLUME_BYTES).cast("long").alias("volume"),
                         F.col("before").alias("offset"), "length", "digest", *(carry or {}))


@dataclass(frozen=True)
class Tree:
    """A replica's records and the nodes of each level, leaf ranges first, the root last."""
    records: DataFrame
    levels: tuple[DataFrame, ...]


def merkle_tree(records: DataFrame, name: str, top: int | None = None) -> Tree:
    """Hash records (offset, length, digest) into a tree over fixed offset ranges.

    A leaf range's hash covers its records in offset order, an inner node's
    hash its children in order, so one task never holds more than a range's
    records or ``FANOUT`` children.  ``top`` is the number of levels (from the
    larger replica); an empty replica has a tree without nodes.
    """
    entry = F.struct("offset", "length", "digest")
    line = lambda r: F.concat_ws(":", r["offset"].cast("string"), r["length"].cast("string"), r["digest"])
    leaves = (records.groupBy(F.floor(F.col("offset") / RANGE_BYTES).cast("long").alias("node"))
              .agg(F.sort_array(F.collect_list(entry)).alias("under"))
              .select("node", F.sha2(F.array_join(F.transform("under", line), "\n"), 256).alias("hash")))
    levels = [store(leaves, f"merkle-{name}-0")]
    top = top or depth(levels[0])
    while len(levels) < top:
        below = levels[-1]
        up = (below.groupBy(F.floor(F.col("node") / FANOUT).cast("long").alias("node"))
              .agg(F.sort_array(F.collect_list(F.struct(F.col("node").alias("child"), "hash"))).alias("under"))
              .select("node", F.sha2(F.array_join(F.transform(
                  "under", lambda c: F.concat_ws(":", c["child"].cast("string"), c["hash"])), "\n"), 256).alias("hash")))
        levels.append(store(up, f"merkle-{name}-{len(levels)}"))
    return Tree(records, tuple(levels))


def depth(leaves: DataFrame) -> int:
    """Levels from the leaf ranges to a single root."""
    last = leaves.agg(F.max("node")).first()[0] or 0
    levels = 1
    while last:
        last, levels = last // FANOUT, levels + 1
    return levels


def audit(a: DataFrame, b: DataFrame, key: str = "page_id") -> DataFrame:
    """Records of replica ``b`` that are not what ``a`` has: status corrupt, missing or extra.

    Roots are compared first; only children of nodes that differ are compared
    on the next level, and only records of ranges that differ are read again.
    Equal replicas give no rows after one comparison of two hashes.  ``a`` and
    ``b`` are manifests with offset, length and digest, best read from storage.
    """
    spans = [r.agg(F.max(F.floor(F.col("offset") / RANGE_BYTES))).first()[0] or 0 for r in (a, b)]
    top, last = 1, max(spans)
    while last:
        last, top = last // FANOUT, top + 1
    left, right = merkle_tree(a, "a", top), merkle_tree(b, "b", top)
    wanted: DataFrame | None = None
    for level in range(top - 1, -1, -1):
        x = left.levels[level].select("node", F.col("hash").alias("hash_a"))
        y = right.levels[level].select("node", F.col("hash").alias("hash_b"))
        if wanted is not None:
            parent = F.floor(F.col("node") / FANOUT).cast("long")
            x, y = (z.withColumn("parent", parent).join(wanted, "parent", "left_semi").drop("parent") for z in (x, y))
        differ = store(x.join(y, "node", "full").filter(~F.col("hash_a").eqNullSafe(F.col("hash_b")))
                       .select(F.col("node").alias("parent")), f"differ-{level}")
        wanted = differ
        if differ.isEmpty():
            break
    home = F.floor(F.col("offset") / RANGE_BYTES).cast("long")
    x, y = (r.withColumn("parent", home).join(wanted, "parent", "left_semi").drop("parent") for r in (a, b))
    x = x.select("offset", *[F.col(c).alias(f"{c}_a") for c in (key, "volume", "length", "digest")])
    y = y.select("offset", *[F.col(c).alias(f"{c}_b") for c in (key, "volume", "length", "digest")])
    status = (F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra")
              .otherwise("corrupt"))
    return (x.join(y, "offset", "full")
            .filter(~(F.col("digest_a").eqNullSafe(F.col("digest_b")) & F.col("length_a").eqNullSafe(F.col("length_b"))))
            .select(F.coalesce(f"{key}_a", f"{key}_b").alias(key), F.coalesce("volume_a", "volume_b").alias("volume"),
                    "offset", F.coalesce("length_a", "length_b").alias("length"), status.alias("status"),
                    "digest_a", "digest_b"))


def op2_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit a replica of the archive of all pages.

    The replica keeps the primary's offsets, as a copied file does, and is
    damaged where page_id leaves 7 by 50 (first letter of the page changed) or
    11 (record lost).
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    kind = F.coalesce(F.col("page_id") % 50, F.lit(0))
    changed = F.when(kind == 7, F.concat(F.lit("#"), F.coalesce(F.expr("substring(html, 2)"), F.lit("")))).otherwise(F.col("html"))
    record = warc_record(F.col("url"), changed)
    both = store(archive(pages, carry={"copy_length": F.octet_length(record).cast("long"), "lost": kind == 11,
                                       "copy_digest": F.sha2(record.cast("binary"), 256)}), "warc-replicas")
    replica = both.filter(~F.col("lost")).select("page_id", "volume", "offset", F.col("copy_length").alias("length"),
                                                 F.col("copy_digest").alias("digest"))
    return audit(both.select(*replica.columns), replica)


ORACLE = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
         CASE WHEN page_id % 50 = 7 THEN '#' || substr(coalesce(html, ''), 2) ELSE coalesce(html, '') END AS copy
  FROM pages),
r AS (
  SELECT page_id,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
           || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10)
           || html || chr(13) || chr(10) || chr(13) || chr(10) AS a,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
           || chr(13) || chr(10) || 'Content-Length: ' || strlen(copy) || chr(13) || chr(10) || chr(13) || chr(10)
           || copy || chr(13) || chr(10) || chr(13) || chr(10) AS b
  FROM p),
d AS (SELECT page_id, strlen(a) AS length, sha256(a) AS digest_a,
             CASE WHEN page_id % 50 = 11 THEN NULL ELSE sha256(b) END AS digest_b FROM r),
o AS (SELECT *, coalesce(sum(length) OVER (ORDER BY page_id NULLS FIRST, digest_a
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM d)
SELECT page_id, CAST(place // 268435456 AS BIGINT) AS volume, CAST(place AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length,
       CASE WHEN digest_b IS NULL THEN 'missing' ELSE 'corrupt' END AS status, digest_a, digest_b
FROM o WHERE digest_b IS NULL OR digest_a <> digest_b
"""
