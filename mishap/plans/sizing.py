"""Widths of the load from the input's size.

AQE merges small shuffle partitions at run time but never splits large
ones (outside skewed joins), so the width of the dedup and layout shuffles
must be set before the load runs, and the scan's splits with it: a shuffle
has (map tasks x partitions) blocks, so both sides grow with the square
root of the work only if their sizes grow together.  At 100 TB the targets
below give some 50,000 tasks of 2 GB on either side, 2.5 x 10^9 blocks of
about 40 KB.  Sizes come from the optimised plan's statistics (file sizes,
adjusted for projections): no job runs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

TARGET_PARTITION_BYTES = 2 * 1024 ** 3
DEFAULT_SPLIT_BYTES = 128 * 1024 ** 2
MAX_SPLITS = 50_000
UNKNOWN_BYTES = 1 << 60
WIDTH, SPLIT = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"


def plan_bytes(df: DataFrame) -> int:
    """Estimated size of ``df``'s scanned input from the optimiser's statistics (no job).

    Inputs that Spark has no size for (it then assumes the largest) count as nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    return sum(s for s in sizes if s < UNKNOWN_BYTES)


def partitions_for(nbytes: int, cores: int, target: int = TARGET_PARTITION_BYTES) -> int:
    return max(cores, math.ceil(nbytes / target))


def split_bytes_for(nbytes: int) -> int:
    """Scan splits: Spark's usual size until there would be over ``MAX_SPLITS`` of them."""
    return max(DEFAULT_SPLIT_BYTES, math.ceil(nbytes / MAX_SPLITS))


@contextmanager
def load_width(df: DataFrame, target: int = TARGET_PARTITION_BYTES) -> Iterator[int]:
    """Within the block, shuffle width and scan splits fit a load of ``df``;
    the previous values are restored on exit.

    Scoped because the width only suits shuffles of whole rows; later
    aggregates shuffle partial results.  Never lowers a setting.
    """
    spark = df.sparkSession
    nbytes = plan_bytes(df)
    before = {k: spark.conf.get(k) for k in (WIDTH, SPLIT)}
    width = max(partitions_for(nbytes, spark.sparkContext.defaultParallelism, target), int(before[WIDTH]))
    spark.conf.set(WIDTH, str(width))
    if split_bytes_for(nbytes) > DEFAULT_SPLIT_BYTES:
        spark.conf.set(SPLIT, str(split_bytes_for(nbytes)))
    try:
        yield width
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
