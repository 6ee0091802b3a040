"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap.plans.materialize import store_path

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of the data folder, read by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and return a frame reading it back.

    Cuts the lineage at a table every executor can read, so a lost executor
    costs a re-read of files.  ``materialize.drop_stored`` removes the folders.
    """
    return df.sparkSession.read.schema(df.schema).parquet(store_path(df, f"llm-{name}"))


def free_name(wanted: str, taken: Sequence[str]) -> str:
    """``wanted``, lengthened until no column of ``taken`` has it (Spark ignores case)."""
    used = {c.lower() for c in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def map_batches(df: DataFrame, fn: Callable[[Batches], Batches], schema: T.StructType | str) -> DataFrame:
    return df.mapInArrow(fn, schema)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batch_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs run within the block send their tasks Arrow batches of about ``most`` bytes (one row at least).

    By default only the rows of a batch are limited, so long texts make batches as
    large as a partition, kept outside the JVM's heap.  The session's own limit is
    restored on exit.
    """
    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH)
        else:
            spark.conf.set(BATCH, before)


def chunks(batches: Batches, column: str, limit: int) -> Batches:
    """Cut batches so each holds about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffers(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column's values, end to end, and the rows' offsets (nulls are empty)."""
    if column.null_count:
        column = column.fill_null("")
    if not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column = column.cast(pa.string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def with_positions(df: DataFrame, order: Sequence[str], size: str, name: str, pos: str = "pos",
                   before: str = "before") -> tuple[DataFrame, int, int]:
    """Global order without a global sort task.

    Rows are range-partitioned by ``order`` (a row number breaks ties, so
    equal keys spread over partitions), sorted inside the partitions, numbered
    and summed there, and stored.  The totals of the partitions (one small row
    each) give every partition's offset.  Returns the rows with ``pos`` (from
    0) and ``before`` (sum of ``size`` over the rows before), the row count
    and the sum of all sizes.
    """
    spark = df.sparkSession
    tie, part, first, start = (free_name(n, [*df.columns, pos, before]) for n in ("tie", "part", "first", "start"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.withColumn(tie, F.monotonically_increasing_id())
              .repartitionByRange(width, *order, tie).sortWithinPartitions(*order, tie).drop(tie))
    schema = T.StructType([*df.schema.fields, T.StructField(part, T.IntegerType()),
                           T.StructField(pos, T.LongType()), T.StructField(before, T.LongType())])

    def number(batches: Batches) -> Batches:
        own, rows, total = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            sizes = b.column(b.schema.get_field_index(size)).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = total + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(sizes), own, np.int32)),
                 pa.array(rows + np.arange(len(sizes), dtype=np.int64)), pa.array(ends - sizes)], names=schema.names)
            rows, total = rows + len(sizes), int(ends[-1]) if len(sizes) else total

    numbered = store(map_batches(ranged, number, schema), name)
    totals = sorted(numbered.groupBy(part).agg(F.count("*"), F.sum(size)).collect())
    offsets, rows, total = [], 0, 0
    for own, n, s in totals:                       # one row per shuffle partition
        offsets.append((own, rows, total))
        rows, total = rows + n, total + int(s)
    starts = spark.createDataFrame(offsets or [(-1, 0, 0)], f"{part} int, {first} long, {start} long")
    placed = (numbered.join(F.broadcast(starts), part)
              .withColumns({pos: F.col(pos) + F.col(first), before: F.col(before) + F.col(start)})
              .drop(part, first, start))
    return placed, rows, total
