"""Scaling check: the load + report + dashboard flow on k copies of ``events``.

Copies get shifted ids (``event_id + copy * 10^9``), so every copy is new
data for the dedup.  Prints one line per k: raw rows, seconds per step and
raw rows per second of the load.  Usage: python scripts/scaling.py [k ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from mishap.operators.cleaning import clean  # noqa: E402
from mishap.plans.dashboard import dashboard  # noqa: E402
from mishap.plans.materialize import store_clean  # noqa: E402
from mishap.plans.report import run_report  # noqa: E402
from mishap.session import local_session  # noqa: E402
from mishap.sources.fixture import raw_incidents_from_events  # noqa: E402


def copies(events: DataFrame, k: int) -> DataFrame:
    """``k`` copies of every event under ids of their own, spread over the cores by
    id (like a large input arriving in many splits)."""
    return (events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            .withColumn("event_id", F.col("event_id") + F.col("copy").cast("long") * 1_000_000_000).select(*events.columns)
            .repartition(events.sparkSession.sparkContext.defaultParallelism, "event_id"))


def main(ks: list[int]) -> None:
    spark = local_session("scaling", shuffle_partitions=16)
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    for k in ks:
        big = copies(events, k)
        raw = raw_incidents_from_events(big)
        for attempt in range(2):  # second attempt is the warm one
            t0 = time.perf_counter()
            table = store_clean(clean(raw), f"scale-{k}")
            t1 = time.perf_counter()
            for v in run_report(table, fused=True).values():
                v.collect()
            t2 = time.perf_counter()
            for name, v in dashboard(table).items():
                v.count() if name == "explorer" else v.collect()  # explorer: the selected rows themselves
            t3 = time.perf_counter()
        n = raw.count()
        print(f"k={k:3d} raw_rows={n:9d} load={t1 - t0:6.2f}s report={t2 - t1:5.2f}s dashboard={t3 - t2:5.2f}s "
              f"load_rows_per_s={n / (t1 - t0):10.0f}", flush=True)


if __name__ == "__main__":
    main([int(a) for a in sys.argv[1:]] or [1, 10, 30])
