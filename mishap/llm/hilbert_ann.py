"""Operator 5: approximate nearest neighbours by shifted Hilbert orderings."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mishap.llm.common import Batches, map_batches, store, table, with_positions

NEIGHBOURS = 10
CURVES = 10
AXES = 6
AXIS_BITS = 8
WINDOW_SHARE = 0.2
"""Share of all distinct vectors that a query meets on one curve.  Vectors without
low-dimensional structure need a share, not a number, for the same recall at every size."""
LEAST_WINDOW = 256
BLOCK = 2048
QUERIES_AT_ONCE = 4096
PAIRS = 8192
SAMPLE = 10_000
"""Vectors, about, from whose projections the axes' ranges are taken."""


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer cells (rows, axes) along the Hilbert curve of ``bits`` bits an axis.

    Cells are turned level by level, highest bit first, so that each subcube
    continues where the one before ended; then the axes' bits are interleaved
    as a Gray code.
    """
    x = [cells[:, k].astype(np.int64) for k in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for k in range(len(x)):
            upper = (x[k] >> level) & 1 == 1
            swap = np.where(upper, 0, (x[0] ^ x[k]) & low)
            flip = np.where(upper, low, 0)
            x[0] = x[0] ^ flip ^ swap
            x[k] = x[k] ^ swap if k else x[0]
    for k in range(1, len(x)):
        x[k] = x[k] ^ x[k - 1]
    parity, turned = x[-1].copy(), np.zeros_like(x[-1])
    for level in range(bits - 1, 0, -1):
        turned ^= np.where((parity >> level) & 1 == 1, (1 << level) - 1, 0)
    key = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turned) >> level) & 1)
    return key


@dataclass(frozen=True)
class Curves:
    """Projections, ranges and shifts of every ordering."""
    axes: np.ndarray
    low: np.ndarray
    span: np.ndarray
    shift: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, curves: int = CURVES, seed: int = 11) -> Curves:
        rng, dims = np.random.default_rng(seed), sample.shape[1]
        n = min(AXES, dims)
        axes = np.stack([np.linalg.qr(rng.standard_normal((dims, dims)))[0][:, :n] for _ in range(curves)])
        y = sample @ axes
        middle, spread = y.mean(axis=1), np.maximum(y.std(axis=1), 1e-12)
        return cls(axes, middle - 3 * spread, 6 * spread, rng.random((curves, n)))

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """(curve, vector): each vector's place on each curve.  A curve's grid is twice
        as wide as the data and shifted by up to half of it."""
        out = []
        for axes, low, span, shift in zip(self.axes, self.low, self.span, self.shift, strict=True):
            at = np.clip((vectors @ axes - low) / span, 0, 1)
            cells = ((at + shift) / 2 * (1 << AXIS_BITS)).astype(np.int64)
            out.append(hilbert_keys(np.clip(cells, 0, (1 << AXIS_BITS) - 1), AXIS_BITS))
        return np.array(out)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector) of the rows that take part: a key; a vector with only finite components, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector")).filter(
        F.col("key").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))


def _place(curves: Curves):
    def run(batches: Batches) -> Batches:
        for b in batches:
            if not b.num_rows:
                continue
            keys = curves.keys(_matrix(b.column(1)))
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(keys), dtype=np.int32), n)), pa.array(keys.ravel()),
                 pa.concat_arrays([b.column(0)] * len(keys)), pa.array(np.ones(n * len(keys), np.int64))],
                names=["curve", "place", "rep", "one"])
    return run


def _meet(k: int, reach: int):
    """Task code for one block: the ``k`` nearest of the block's candidates in each query's window."""
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if queries.num_rows and candidates.num_rows:
            c, ranks = _matrix(candidates["vector"].combine_chunks()), candidates["rank"].to_numpy()
            reps, square = candidates["rep"].to_numpy(), (c * c).sum(axis=1)
            q_all, q_ranks, q_reps = _matrix(queries["vector"].combine_chunks()), queries["rank"].to_numpy(), queries["rep"].to_numpy()
            for at in range(0, len(q_all), 256):
                q = q_all[at:at + 256]
                d = square[None, :] - 2 * q @ c.T
                d[np.abs(q_ranks[at:at + 256, None] - ranks[None, :]) > reach] = np.inf
                n = min(k, len(c))
                # all up to the k-th distance, with room for the rounding of the quick formula: ties stay
                limit = np.partition(d, n - 1, axis=1)[:, n - 1] + 1e-11 * (square.max() + (q * q).sum(axis=1))
                row, best = np.nonzero(d <= np.minimum(limit, np.finfo(np.float64).max)[:, None])
                exact = np.concatenate([np.sqrt(((c[best[i:i + PAIRS]] - q[row[i:i + PAIRS]]) ** 2).sum(axis=1))
                                        for i in range(0, len(row) or 1, PAIRS)])
                order = np.lexsort([reps[best], exact, row])
                row, best, exact = row[order], best[order], exact[order]
                good = np.arange(len(row)) - np.searchsorted(row, row) < k
                out[0].append(q_reps[at:at + 256][row[good]])
                out[1].append(reps[best[good]])
                out[2].append(exact[good])
        none = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table([pa.array(np.concatenate([n, *x])) for n, x in zip(none, out, strict=True)],
                        names=["query_rep", "rep", "score"])
    return run


def nearest(vectors: DataFrame, is_query: str, key: str = "vec_id", vector: str = "embedding",
            k: int = NEIGHBOURS, curves: int = CURVES, share: float = WINDOW_SHARE) -> DataFrame:
    """The ``k`` nearest rows found of every row that the SQL condition ``is_query`` on ``key`` picks.

    Equal vectors are one point with its k + 1 smallest keys, so a vector of a
    third of all rows costs one row.  Points are ordered along ``curves``
    Hilbert curves of random projections, each on a shifted grid, by range
    partitions; a query meets the points at most half of ``share`` of them away
    on each curve, block by block, and the blocks' finds are merged and ranked
    by exact distance.

    Returns query_id, rank (from 1), vec_id, score: Euclidean distance in double
    precision, ties to the smaller key.  Rows with a null key, a null or zero
    vector or null or non-finite components take no part.  Vectors of each
    length are searched among themselves, one length after the other.  Rows
    that repeat a key are candidates of their own, and no query's own key.
    """
    good = store(usable(vectors, key, vector).withColumn("asks", F.expr(is_query.replace(key, "key"))), "ann-vectors")
    sizes = sorted(r["n"] for r in good.filter("asks").select(F.size("vector").alias("n")).distinct().collect())
    found = [_nearest(good.filter(F.size("vector") == n), k, curves, share) for n in sizes]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionAll, found)


def _nearest(good: DataFrame, k: int, curves: int, share: float) -> DataFrame:
    """``nearest`` of stored (key, vector, asks) rows with vectors of one length."""
    by_vector = Window.partitionBy("vector")
    members = (good.withColumn("n", F.row_number().over(by_vector.orderBy("key"))).filter(f"n <= {k + 1}")
               .select("key", F.min("key").over(by_vector).alias("rep")))
    points = store(good.groupBy("vector").agg(F.min("key").alias("rep"), F.max("asks").alias("asks")), "ann-points")
    count = points.count()
    chance = F.pmod(F.xxhash64("rep"), F.lit(1_000_003)) / F.lit(1_000_003)
    sample = points.filter(chance < max(SAMPLE, 100) / count).select("vector").limit(2 * SAMPLE).collect()
    sample = sample or points.select("vector").limit(1).collect()
    fitted = Curves.fit(np.array([r["vector"] for r in sample], np.float64), curves)
    placed = map_batches(points.select("rep", "vector"), _place(fitted), "curve int, place long, rep long, one long")
    ordered, _, _ = with_positions(store(placed, "ann-places"), ["curve", "place", "rep"], "one", "ann-order")
    reach = max(LEAST_WINDOW, math.ceil(share * count / 2))
    parts = max(1, math.ceil((2 * reach + BLOCK) / 100 / QUERIES_AT_ONCE))
    ranked = store(ordered.select("curve", (F.col("pos") - F.col("curve").cast("long") * count).alias("rank"), "rep")
                   .join(points, "rep"), "ann-ranked")
    block = lambda rank: F.floor(rank / BLOCK).cast("int")
    last = (count - 1) // BLOCK
    candidates = ranked.select("curve", block(F.col("rank")).alias("block"), "rank", "rep", "vector",
                               F.explode(F.array(*map(F.lit, range(parts)))).alias("part"))
    queries = ranked.filter("asks").select(
        "curve", F.explode(F.sequence(F.greatest(F.lit(0), block(F.col("rank") - reach)),
                                      F.least(F.lit(last), block(F.col("rank") + reach)))).alias("block"),
        "rank", "rep", "vector", F.pmod(F.xxhash64("rep"), F.lit(parts)).cast("int").alias("part"))
    at = ["curve", "block", "part"]
    found = (queries.groupBy(*at).cogroup(candidates.groupBy(*at))
             .applyInArrow(_meet(k + 1, reach), "query_rep long, rep long, score double"))
    best = (found.dropDuplicates(["query_rep", "rep"])
            .withColumn("n", F.row_number().over(Window.partitionBy("query_rep").orderBy("score", "rep")))
            .filter(f"n <= {k + 1}").drop("n"))
    asked = good.filter("asks").select(F.col("key").alias("query_id"), "vector").distinct().join(
        points.select("vector", F.col("rep").alias("query_rep")), "vector").select("query_id", "query_rep")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (best.join(members.withColumnRenamed("key", "vec_id"), "rep").join(asked, "query_rep")
            .filter("vec_id <> query_id").withColumn("rank", rank).filter(f"rank <= {k}")
            .select("query_id", "rank", "vec_id", "score"))


def op5_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")
