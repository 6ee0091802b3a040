"""Cutting lineage in the shared folder.

A long plan (dedup shuffle + parsing) is written once as Parquet under the
folder the cluster names in ``spark.checkpoint.dir`` and read back; later
jobs start from that table, so a lost executor costs a re-read of a few
files, not a recomputation from the raw source.  No machine-local folder
and no local checkpoint is ever used.  Folders stay until ``drop`` or
``drop_stored`` removes them, on whatever file system they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from mishap.functions.columns import free_name
from mishap.operators.cleaning import clean_rows, standardize_column_names
from mishap.plans.sizing import load_width, plan_bytes
from mishap.session import ensure_shared_dir

_WRITTEN: list[str] = []


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def drop(spark: SparkSession, path: str) -> None:
    """Remove a stored folder."""
    place, files = _file_system(spark, path)
    files.delete(place, True)
    if path in _WRITTEN:
        _WRITTEN.remove(path)


def drop_stored(spark: SparkSession) -> int:
    """Remove every folder this process has stored; returns how many."""
    paths = list(_WRITTEN)
    for path in paths:
        drop(spark, path)
    return len(paths)


def listing(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """(name, bytes, time) of the files at ``path``, from its own file system."""
    place, files = _file_system(spark, path)
    return tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime())
                        for s in files.listStatus(place)))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_shared_dir(spark).rstrip('/')}/mishap/{name}-{uuid.uuid4().hex}"


def store_path(df: DataFrame, name: str, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> str:
    """Write ``df`` as Parquet under a fresh folder of the shared folder; return the path."""
    path = new_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _WRITTEN.append(path)
    writer.parquet(path)
    return path


def load(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read a stored table (columns in the given order)."""
    back = spark.read.parquet(path)
    return back.select(*columns) if columns else back


def store(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder, as its last stage leaves it,
    and return a frame reading it (same column order as ``df``)."""
    return reread(df, store_path(df, name, partition_by))


def reread(df: DataFrame, path: str) -> DataFrame:
    """The table that ``df`` was written to, with its schema (none to be inferred, so an empty table has one)."""
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


# A stored result of at most so many rows is read as one partition.
SMALL_ROWS = 100_000


def store_result(df: DataFrame, name: str) -> tuple[DataFrame, bool]:
    """``store`` for grouped results, their rows counted while they are written; also whether it is small.

    A small one comes back as one partition, so that roll-ups and sorts of it
    need no exchange and no sampling job; a larger one stays distributed.
    """
    rows = Observation()
    back = reread(df, store_path(df.observe(rows, F.count(F.lit(1)).alias("rows")), name))
    small = rows.get["rows"] <= SMALL_ROWS
    return (back.coalesce(1) if small else back), small


# How the clean table is laid out: year folders (pruned by date ranges), and
# inside them files that each cover a narrow range of places and dates.
CLEAN_PARTITIONS = ("year",)
CLEAN_CLUSTERING = ("city", "date")
# Looked up by single values (F1, F8): a Bloom filter in each row group skips it where its range would not.
POINT_COLUMNS = ("city", "id")


def point_filters(df: DataFrame) -> dict[str, str]:
    """Parquet writer options for Bloom filters on the columns that point filters name (sized by their values)."""
    named = [c for c in POINT_COLUMNS if c in df.columns]
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in named}
    return options | ({"parquet.bloom.filter.adaptive.enabled": "true"} if named else {})


def laid_out(clean_df: DataFrame, width: int | None = None, partition_by: Sequence[str] = CLEAN_PARTITIONS,
             cluster_by: Sequence[str] = CLEAN_CLUSTERING) -> DataFrame:
    """The clean rows dealt by ranges of year, place and date and sorted so.

    Rows leave the dedup in hash order, every file spanning every place; dealt
    by ranges, a file holds a few places, so Parquet statistics skip whole
    files for filters on them.  The id (or a row hash) is the last range key:
    a place with a third of all rows is cut into many ranges.
    """
    keys = [c for c in (*partition_by, *cluster_by) if c in clean_df.columns]
    last = F.col("id") if "id" in clean_df.columns else F.xxhash64(*clean_df.columns)
    end = free_name("last", clean_df.columns)
    hot = clean_df.withColumn(end, last)
    width = width or int(clean_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return hot.repartitionByRange(width, *keys, end).sortWithinPartitions(*keys, end).drop(end)


# Rows drawn for the bounds of each range, and for all of them.
RANGE_ROWS, BOUND_ROWS = 20, 1_000_000
RAW_ROW_BYTES = 64
# From this size of the raw input on, a second run of the dedup's reduce side costs more than drawing bounds.
ONE_PASS_BYTES = 1024 ** 3


def range_bounds(source: DataFrame, width: int, keys: Sequence[str]) -> Column | None:
    """Bounds of ``width`` ranges of about equal numbers of clean rows, drawn from the raw rows: one query below the dedup.

    Rows are drawn by the hash of their raw keys, so copies are drawn together
    and count once, as after the dedup.  Of the drawn rows those with the
    smallest hashes are kept, ``BOUND_ROWS`` at most, and sorted in one task.
    The result is a constant: an array of at most ``width`` - 1 keys, ascending
    (some 3 MB at 50,000 ranges).  None without rows.
    """
    named = standardize_column_names(source)
    draw = max(1, plan_bytes(source) // (RAW_ROW_BYTES * RANGE_ROWS * width))
    number = free_name("draw", named.columns)
    raw_keys = [c for c in ("id", "city", "date", "time") if c in named.columns]
    hashed = named.withColumn(number, F.xxhash64(*raw_keys)).where(F.col(number) % draw == 0)
    drawn = clean_rows(hashed).select(F.struct(*keys).alias("key"), F.col(number).alias("draw")).distinct()
    kept = drawn.orderBy("draw").limit(BOUND_ROWS)
    placed = kept.select("key", F.row_number().over(Window.orderBy("key", "draw")).alias("place"),
                         F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
    step = F.floor(F.col("place") * width / F.col("n"))
    cuts = placed.where((step > F.floor((F.col("place") - 1) * width / F.col("n"))) & (step < width)).select("key")
    bounds = cuts.distinct().agg(F.array_sort(F.collect_list("key")).alias("bounds"), F.count(F.lit(1)).alias("n"))
    found = bounds.select(F.to_json("bounds", {"ignoreNullFields": "false"}), "n").first()
    return F.from_json(F.lit(found[0]), bounds.schema["bounds"].dataType) if found[1] else None


def range_number(key: Column, bounds: Column, most: int) -> Column:
    """How many of the ascending ``bounds`` are not above ``key``, by bisection."""
    steps = max(1, most.bit_length() + 1)

    def halve(found: Column, _: Column) -> Column:
        middle = ((found["low"] + found["high"]) / 2).cast("int")
        right = F.get(bounds, middle) <= key
        more = found["low"] < found["high"]
        return F.struct(F.when(more & right, middle + 1).otherwise(found["low"]).alias("low"),
                        F.when(more & ~right, middle).otherwise(found["high"]).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["low"]


def laid_out_by(clean_df: DataFrame, source: DataFrame, width: int, partition_by: Sequence[str] = CLEAN_PARTITIONS,
                cluster_by: Sequence[str] = CLEAN_CLUSTERING) -> DataFrame:
    """``laid_out`` with bounds drawn from the raw rows ``source`` that ``clean_df`` cleans.

    Spark's range dealing samples its input, which runs the reduce side of the
    dedup twice.  Here each row's range is known from stored bounds, and
    ``repartitionById`` deals by that number: the dedup is reduced once.
    """
    keys = [c for c in (*partition_by, *cluster_by) if c in clean_df.columns]
    if not keys or "id" not in clean_df.columns:
        return laid_out(clean_df, width, partition_by, cluster_by)
    keys = [*keys, "id"]
    found = range_bounds(source, width, keys)
    if found is None:                                # no rows, or too few to cut
        return clean_df.sortWithinPartitions(*keys)
    number = free_name("range", clean_df.columns)
    own = F.struct(*keys)
    dealt = clean_df.withColumn(number, range_number(own, found, width))
    return dealt.repartitionById(width, number).drop(number).sortWithinPartitions(*keys)


def dealt_out(clean_df: DataFrame, source: DataFrame | None, width: int, partition_by: Sequence[str] = CLEAN_PARTITIONS,
              cluster_by: Sequence[str] = CLEAN_CLUSTERING) -> DataFrame:
    """The clean rows laid out, by drawn bounds where the raw rows are given and large enough."""
    if source is None or plan_bytes(source) < ONE_PASS_BYTES:
        return laid_out(clean_df, width, partition_by, cluster_by)
    return laid_out_by(clean_df, source, width, partition_by, cluster_by)


def store_clean(clean_df: DataFrame, name: str = "clean", source: DataFrame | None = None) -> DataFrame:
    """Store the clean table in the shared folder with the layout above.

    The widths of its shuffles and scan follow the input's size (no job).
    With ``source``, the raw rows that ``clean_df`` cleans, a large input's
    bounds are drawn from them and the dedup's reduce side runs once.
    """
    return reread(clean_df, store_clean_path(clean_df, name, source))


def store_clean_path(clean_df: DataFrame, name: str = "clean", source: DataFrame | None = None) -> str:
    parts = tuple(c for c in CLEAN_PARTITIONS if c in clean_df.columns)
    with load_width(clean_df) as width:
        dealt = dealt_out(clean_df, source, width, parts)
        return store_path(dealt, name, parts, point_filters(clean_df))
