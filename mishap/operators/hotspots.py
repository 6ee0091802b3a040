"""Map sample and hotspot grid (M1-M3).

The sample is the ``n`` rows with the smallest row hash: the same rows
whatever the partitioning, and never a driver-side sample.  A plain
``orderBy(hash).limit(n)`` sends n rows from EVERY input partition to one
task, so one global aggregate first counts the rows under a fixed ladder of
hash limits (each a quarter of the one before; a few numbers per task), and
the smallest limit that keeps n rows filters the scan: some n to 4n rows are
left for the top-k.  Exact, whatever the hashes are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap.constants import HIGH, HOTSPOT_COLUMNS, MAP_SAMPLE_SEED, MAP_SAMPLE_SIZE
from mishap.functions.columns import free_name
from mishap.operators.filters import with_coordinates
from mishap.schema import DERIVED_COLUMNS

LIMITS = tuple(1 << (32 - 2 * k) for k in range(15, -1, -1))


def sample_key(df: DataFrame, seed: int = MAP_SAMPLE_SEED) -> Column:
    """MD5 of the seed and the row's text and whole-number columns, NULL as empty.

    Derived columns and parsed dates only make the expression long;
    floating-point columns have no text form that all engines share.  Rows
    with equal keys are ordered by all columns.
    """
    plain = (T.StringType, T.IntegerType, T.LongType)
    cols = [f.name for f in df.schema.fields if f.name not in DERIVED_COLUMNS and isinstance(f.dataType, plain)]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def hash_sample(df: DataFrame, n: int, seed: int = MAP_SAMPLE_SEED) -> DataFrame:
    """The ``n`` rows with the smallest row hash (ties by row), exact and repeatable."""
    cols = df.columns
    key = free_name("sample_hash", cols)
    keyed = df.withColumn(key, sample_key(df, seed))
    place = F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")
    # rung k holds the hashes from limit k-1 up to limit k: at most 16 groups
    rung = F.greatest(F.lit(0), F.ceil((F.log2(place + 1) - 2) / 2)).cast("int")
    rungs = keyed.groupBy(rung.alias("rung")).agg(F.count(F.lit(1)).alias("n"))
    under = rungs.agg(*[F.sum(F.when(F.col("rung") <= k, F.col("n"))).alias(f"n{k}") for k in range(len(LIMITS))])
    cutoff = F.lit(LIMITS[-1])
    for k in reversed(range(len(LIMITS))):
        cutoff = F.when(F.col(f"n{k}") >= n, F.lit(LIMITS[k])).otherwise(cutoff)
    kept = keyed.where(place < under.select(cutoff.alias("cutoff")).scalar())
    return kept.orderBy(key, *cols).limit(n).select(*cols)


def hotspot_points(df: DataFrame, n: int = MAP_SAMPLE_SIZE, seed: int = MAP_SAMPLE_SEED,
                   columns: Sequence[str] = HOTSPOT_COLUMNS) -> DataFrame:
    """M1+M2: up to ``n`` rows with coordinates, a fixed-seed repeatable sample,
    projected to the map columns.  No coordinate columns -> no rows."""
    if "latitude" not in df.columns or "longitude" not in df.columns:
        return df.limit(0).select(*[c for c in columns if c in df.columns])
    points = hash_sample(with_coordinates(df), n, seed)
    return points.select(*[c for c in columns if c in df.columns])


SKETCH_GROUP = ("city", "severity", "year", "month")
SKETCH_SALTS = 64


def points_sketch(df: DataFrame, n: int = MAP_SAMPLE_SIZE, seed: int = MAP_SAMPLE_SEED) -> DataFrame:
    """M1/M2: a bottom-k sketch of the rows with coordinates: of each place, severity and month the ``n`` rows
    with the smallest row hash, all columns and ``sample_hash``.

    The ``n`` smallest of any union of whole groups are among the groups' own
    ``n`` smallest, so the sample of any selection by place, severity and
    months comes exactly from the sketch, and sketches of several loads merge
    by ``merge_sketches``.  A group holding a third of all rows is first cut
    into parts by its hash, each keeping its own ``n``.  Store it once.
    """
    keyed = with_coordinates(df)
    return _smallest(keyed.withColumn("sample_hash", sample_key(keyed, seed)), df.columns, n)


def merge_sketches(sketches: DataFrame, n: int = MAP_SAMPLE_SIZE) -> DataFrame:
    """One sketch from the rows of several (a union of ``points_sketch`` results of distinct rows)."""
    return _smallest(sketches, [c for c in sketches.columns if c != "sample_hash"], n)


def _smallest(keyed: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    salt, rank = free_name("salt", keyed.columns), free_name("rank", keyed.columns)
    order = ["sample_hash", *columns]
    part = Window.partitionBy(*SKETCH_GROUP, salt).orderBy(*order)
    group = Window.partitionBy(*SKETCH_GROUP).orderBy(*order)
    some = (keyed.withColumn(salt, F.pmod(F.xxhash64("sample_hash"), F.lit(SKETCH_SALTS)))
            .withColumn(rank, F.row_number().over(part)).where(F.col(rank) <= n))
    return some.withColumn(rank, F.row_number().over(group)).where(F.col(rank) <= n).drop(salt, rank)


def points_from_sketch(selection: DataFrame, n: int = MAP_SAMPLE_SIZE, columns: Sequence[str] = HOTSPOT_COLUMNS) -> DataFrame:
    """``hotspot_points`` of a selection of whole sketch groups (places, severities, whole months), read from the sketch."""
    order = ["sample_hash", *[c for c in selection.columns if c != "sample_hash"]]
    return selection.orderBy(*order).limit(n).select(*[c for c in columns if c in selection.columns])


def grid_cells(step: float = 0.5) -> dict[str, Column]:
    """Integer cell indices of a ``step``-degree grid (NULL without a coordinate)."""
    s = F.lit(float(step))
    return {"cell_lat": F.floor(F.col("latitude") / s).cast("bigint"),
            "cell_lon": F.floor(F.col("longitude") / s).cast("bigint")}


def with_cell_centers(cells: DataFrame, step: float = 0.5) -> DataFrame:
    s = F.lit(float(step))
    return cells.withColumns({"lat_center": (F.col("cell_lat") + 0.5) * s,
                              "lon_center": (F.col("cell_lon") + 0.5) * s})


def hotspot_grid(df: DataFrame, step: float = 0.5) -> DataFrame:
    """M3: incidents and High incidents per ``step``-degree grid cell.

    A map at scale needs density, not points: one hash aggregate on the cell,
    combined map-side, so a hot cell never gathers in one task.
    """
    cells = grid_cells(step)
    grid = (with_coordinates(df)
            .groupBy(cells["cell_lat"].alias("cell_lat"), cells["cell_lon"].alias("cell_lon"))
            .agg(F.count(F.lit(1)).alias("incidents"),
                 F.count_if(F.col("severity") == HIGH).alias("high_incidents")))
    return with_cell_centers(grid, step)


FINEST_STEP = 1 / 128
"""Degrees of a pyramid's finest cells: a power of two, as every coarser step of it is."""
CELL_BITS = 31


def _spread(bits: Column) -> Column:
    """A number's lower 31 bits with a zero bit between any two."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask))
    return bits


def _gathered(bits: Column) -> Column:
    """Every second bit of a number, from the lowest on: ``_spread`` undone."""
    bits = bits.bitwiseAND(F.lit(0x5555555555555555))
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF),
                        (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        bits = bits.bitwiseOR(F.shiftright(bits, shift)).bitwiseAND(F.lit(mask))
    return bits


def grid_pyramid(df: DataFrame, step: float = FINEST_STEP) -> DataFrame:
    """M3 at any zoom: incidents and High incidents by the Z-order key of their finest cell.

    A key interleaves the bits of both cell numbers, so the key of the cell
    twice as wide is the same without its last two bits: one stored table, a
    row for each finest cell that has rows, gives every coarser grid
    (``grid_from_pyramid``), and the tables of several loads add up by union.
    Coordinates of over 2^30 cells from zero, which no place has, are counted
    under a NULL key.
    """
    cells = grid_cells(step)
    middle = 1 << (CELL_BITS - 1)
    inside = (F.abs(cells["cell_lat"]) < middle) & (F.abs(cells["cell_lon"]) < middle)
    key = _spread(cells["cell_lat"] + middle).bitwiseOR(F.shiftleft(_spread(cells["cell_lon"] + middle), 1))
    return (with_coordinates(df).groupBy(F.when(inside, key).alias("cell"))
            .agg(F.count(F.lit(1)).alias("incidents"), F.count_if(F.col("severity") == HIGH).alias("high_incidents")))


def grid_from_pyramid(pyramid: DataFrame, step: float, finest: float = FINEST_STEP) -> DataFrame:
    """``hotspot_grid`` of a ``step`` that is the finest one times a power of two, from the stored cells alone."""
    level = math.log2(step / finest)
    if level < 0 or level >= CELL_BITS or level != int(level):
        raise ValueError(f"step {step} is not {finest} times a power of two")
    level = int(level)
    middle = 1 << (CELL_BITS - 1 - level)
    sums = (pyramid.where(F.col("cell").isNotNull()).groupBy(F.shiftright("cell", 2 * level).alias("cell"))
            .agg(F.sum("incidents").alias("incidents"), F.sum("high_incidents").alias("high_incidents")))
    grid = sums.select((_gathered(F.col("cell")) - middle).alias("cell_lat"),
                       (_gathered(F.shiftright("cell", 1)) - middle).alias("cell_lon"), "incidents", "high_incidents")
    return with_cell_centers(grid, step)
