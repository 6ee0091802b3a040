"""Session helpers.

Library code never builds its own session: every operator takes a
DataFrame and uses ``df.sparkSession``.  ``local_session`` exists for
tests, the bench and notebooks; on a cluster the launcher's session is used
as it is.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the incident workloads at any scale.  AQE merges
# small shuffle partitions at run time and splits skewed joins (not skewed
# aggregates; those combine map-side), so no operator hard-codes a partition count.
SCALE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Year-partitioned writes keep a few files open per task instead of
    # sorting every task's rows by the partition column first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Range dealing draws more rows for its bounds, so layouts come out alike from run to run
    # (Spark keeps the whole draw under 10^6 rows).
    "spark.sql.execution.rangeExchange.sampleSizePerPartition": "500",
    # Column statistics are not needed; broadcasts are explicit and bounded.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def get_session(app_name: str = "mishap", extra: dict[str, str] | None = None) -> SparkSession:
    """The session for a job: master, memory and shuffle width come from
    the launcher (``spark-submit``); only the scale settings above are added
    (AQE sizes the shuffles at run time).  Log level ERROR."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def local_session(app_name: str = "mishap", cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, shared dir set if unset)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.session.timeZone", "UTC"))
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_shared_dir(spark)
    return spark


def ensure_shared_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a scratch one only if none is set.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach (HDFS, S3, ...); it is read from the session and never replaced,
    and a cluster session without it is an error.  Only a local session
    without it (tests) gets a fresh temporary folder.
    """
    current = shared_dir(spark, required=False)
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="mishap-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def shared_dir(spark: SparkSession, required: bool = True) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (session or context)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path and required:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder shared by all executors")
    return path
