"""Operator 1: contiguous balanced shards by global byte-size prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mishap.llm.common import store, table, with_positions

SHARDS = 16


def byte_size(text: str = "text") -> F.Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Put every row into one of ``shards`` contiguous ranges of the key order, of near equal bytes.

    The rows' keys, sizes and checksums (never the texts) are ordered by range
    partitions; sums of the partitions' totals give each row the bytes before
    it, and a row goes to the shard in whose equal share of all bytes it
    starts.  Shards differ by less than one row from their share.

    Rows with a null key come first, equal keys are ordered by size and
    checksum, equal rows are kept as separate rows, a null text has size 1 and
    a null checksum, an empty table gives no rows.  Only key and text are read.
    """
    slim = store(docs.select(F.col(key), byte_size(text).alias("size"),
                             F.crc32(F.col(text).cast("binary")).alias("text_crc32")), "shard-sizes")
    placed, _, total = with_positions(slim, [key, "size", "text_crc32"], "size", "shard-order")
    share = F.floor((F.col("before").cast("decimal(38,0)") * shards) / F.lit(max(total, 1)).cast("decimal(20,0)"))
    sharded = placed.withColumn("shard", share.cast("int"))
    first = dict(sharded.groupBy("shard").agg(F.min("pos")).collect())     # at most one row per shard
    starts = F.array(*[F.lit(first.get(s, 0)).cast("long") for s in range(shards)])
    return sharded.select(key, "size", "text_crc32", "shard",
                          (F.col("pos") - starts[F.col("shard")]).alias("slot"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


ORACLE = """
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
                CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(i))),
raw AS (
  SELECT doc_id, text, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                      lambda h: CAST('0x' || h AS BIGINT)) AS bytes FROM documents),
sized AS (
  SELECT doc_id, CAST(len(bytes) + 1 AS BIGINT) AS size,
         CASE WHEN text IS NOT NULL THEN CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
           lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])), 4294967295) AS BIGINT) END AS text_crc32
  FROM raw, crc_table),
placed AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 NULLS FIRST
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bytes_before,
         sum(size) OVER () AS total FROM sized),
sharded AS (SELECT *, CAST(bytes_before * 16 // total AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY bytes_before) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM sharded
"""
