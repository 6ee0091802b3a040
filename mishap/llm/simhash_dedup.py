"""Operator 8: SimHash near-duplicates, pairs discarded by pivot distance tables."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap.llm.common import Batches, chunks, free_name, map_batches, store, table
from mishap.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
PIVOTS = 24
CHUNK_BYTES = 2 * 1024 * 1024
CROWD = 4096
"""Fingerprints of one block key that one task compares; larger crowds are cut into parts compared two by two."""

MAX_BROADCAST = 1_000_000
"""Keys of crowds that are sent to every task."""

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text: bit k is set if it is in over half of the shingles' XXH64 values.

    Shingles are runs of ``words`` words joined by a space, repeats included;
    fewer words are one shingle, no word gives zero.
    """
    found = _WORD.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER))
    if not found:
        return 0
    flat = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    if len(found) <= words:
        return xxhash.xxh64_intdigest(flat, SEED)
    starts, stops = (ends - sizes)[:len(found) - words + 1].tolist(), ends[words - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(flat[i:j], SEED) for i, j in zip(starts, stops, strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), 16384):
        bits = np.unpackbits(values[at:at + 16384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > len(values), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                 *more: str) -> DataFrame:
    """(key, columns of ``more``, fp) of every whole text; a null text has no words.  fp is the fingerprint as a signed long."""
    schema = T.StructType([*[docs.schema[c] for c in (key, *more)], T.StructField("fp", T.LongType())])

    def run(batches: Batches) -> Batches:
        for b in chunks(batches, text, CHUNK_BYTES):
            found = np.array([fingerprint(t or "", words) for t in b.column(1 + len(more)).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found.view(np.int64))], names=schema.names)

    return map_batches(docs.select(key, *more, text), run, schema)


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, from the hash of their numbers."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % k, SEED) for k in range(n)], np.uint64)


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints to every pivot, one column each."""
    return np.bitwise_count(fps[:, None] ^ pivots()[None, :]).astype(np.int8)


def near(fps: np.ndarray, distances: np.ndarray, i: np.ndarray, j: np.ndarray, bits: int) -> np.ndarray:
    """Which pairs (i, j) are linked: those with a coordinate over ``bits`` apart
    are discarded pivot by pivot (the triangle inequality), the rest verified."""
    left = np.arange(len(i))
    for k in range(distances.shape[1]):
        if not len(left):
            break
        column = distances[:, k]
        left = left[np.abs(column[i[left]] - column[j[left]]) <= bits]
    return left[np.bitwise_count(fps[i[left]] ^ fps[j[left]]) <= bits]


def crowd_links(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same fingerprints as all links among ``fps``, at most one each.

    Every fingerprint reached is compared once with those not reached yet, so
    no list of all pairs is made.
    """
    table_, rest = pivot_table(fps), np.arange(len(fps))
    a, b = [], []
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            node, front = front[0], front[1:]
            hit = near(fps, table_, np.full(len(rest), node), rest, bits)
            if len(hit):
                a.append(np.full(len(hit), node))
                b.append(rest[hit])
                front = np.concatenate([front, rest[hit]])
                rest = np.delete(rest, hit)
    none = np.zeros(0, np.int64)
    return (fps[np.concatenate(a)], fps[np.concatenate(b)]) if a else (fps[none], fps[none])


def block_masks(blocks: int, bits: int) -> list[int]:
    """Masks of every choice of ``blocks - bits`` of the blocks that 64 bits are cut into.

    Fingerprints at most ``bits`` apart agree on all bits of one mask at least.
    """
    edges = [64 * k // blocks for k in range(blocks + 1)]
    part = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(part, blocks - bits)]


def blocks_for(n: int, bits: int = MAX_BITS) -> int:
    """The fewest blocks (two kept at least) whose keys hold 16 random fingerprints or less."""
    blocks = bits + 2
    while blocks < 16 and n / 2 ** (64 * (blocks - bits) / blocks) > 16:
        blocks += 1
    return blocks


def _compare(bits: int):
    """Task code: links of rows that arrive sorted by key."""
    def run(batches: Batches) -> Batches:
        tail_k, tail_f = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64)
        none = np.zeros(0, np.uint64)

        def emit(a, b):
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        def work(keys, fps):
            if len(fps) < 2:
                return
            new = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            first = np.concatenate([[0], new])
            size = np.diff(np.concatenate([first, [len(fps)]]))
            for s in np.flatnonzero(size > 64):
                yield emit(*crowd_links(fps[first[s]:first[s] + size[s]], bits))
            some = np.repeat((size > 1) & (size <= 64), size)
            end = np.repeat(first + size, size)[some]
            at = np.flatnonzero(some)
            if not len(at):
                return
            distances = np.zeros((len(fps), PIVOTS), np.int8)
            distances[at] = pivot_table(fps[at])
            for step in range(1, int(size[size <= 64].max())):
                keep = at + step < end
                at, end = at[keep], end[keep]
                hit = near(fps, distances, at, at + step, bits)
                if len(hit):
                    yield emit(fps[at[hit]], fps[at[hit] + step])

        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(0).to_numpy().astype(np.int64), b.column(1).to_numpy()], axis=1)
            keys, fps = np.concatenate([tail_k, k]), np.concatenate([tail_f, b.column(2).to_numpy().view(np.uint64)])
            last = np.flatnonzero(np.any(keys != keys[-1], axis=1))
            cut = last[-1] + 1 if len(last) else 0
            yield from work(keys[:cut], fps[:cut])
            tail_k, tail_f = keys[cut:], fps[cut:]
        yield from work(tail_k, tail_f)
        yield emit(none, none)

    return run


def candidates(distinct: DataFrame, bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """(mask, key, fp): fingerprints to compare with each other are those of equal mask and key.

    They agree on the blocks of one mask.  Keys are counted first (a grouped
    count, combined before it moves); one with more than ``crowd``
    fingerprints is cut into parts by hash, and every two parts get a key of
    their own, so no task receives a whole crowd.
    """
    masks = block_masks(blocks_for(distinct.count(), bits), bits)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = distinct.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for k, m in enumerate(signed)])).alias("k"), "fp").select("k.mask", "k.key", "fp")
    parts = F.ceil(F.col("count") / crowd).cast("int").alias("parts")
    crowds = store(keyed.groupBy("mask", "key").count().filter(F.col("count") > crowd).select("mask", "key", parts),
                   "simhash-crowds")
    n = crowds.count()
    if not n:
        return keyed
    # Past the bound the join is left to Spark, which cuts skewed partitions.
    marked = keyed.join(F.broadcast(crowds) if n <= MAX_BROADCAST else crowds, ["mask", "key"], "left")
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda o: F.struct(F.least(o, F.col("part")).alias("i"), F.greatest(o, F.col("part")).alias("j")))
    cut = (marked.filter("parts is not null").withColumn("part", part).withColumn("pair", F.explode(pairs))
           .select((F.col("mask") + len(masks)).alias("mask"), F.xxhash64("mask", "key", "pair.i", "pair.j").alias("key"), "fp"))
    return marked.filter("parts is null").select("mask", "key", "fp").union(cut)


def links(distinct: DataFrame, bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """(a, b) links among distinct fingerprints (column fp) that connect whatever all links connect.

    Of the candidates, pivot tables discard and the bits verify.
    """
    dealt = candidates(distinct, bits, crowd).repartition("mask", "key").sortWithinPartitions("mask", "key")
    return map_batches(dealt, _compare(bits), "a long, b long")


def classes(fps: DataFrame, least: dict[str, Column], bits: int = MAX_BITS) -> DataFrame:
    """(fp, component, ...): the class of every fingerprint in ``fps``, with the class's minimum of each of ``least``.

    Classes are the fingerprints reachable by links at most ``bits`` apart.
    Equal fingerprints are joined first, so copies cost one row.
    """
    groups = store(fps.groupBy("fp").agg(*[F.min(c).alias(n) for n, c in least.items()]), "simhash-groups")
    nodes = connected_components(links(groups.select("fp"), bits))
    of = groups.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    first = of.groupBy("component").agg(*[F.min(n).alias(n) for n in least])
    return store(of.select("fp", "component").join(first, "component").select("fp", "component", *least), "simhash-classes")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: key, fp (signed long) and component_id.

    component_id is the smallest key among all rows reachable by links of
    fingerprints at most ``bits`` apart; where keys repeat, classes with the
    same smallest key share it.  Null and empty texts share the zero
    fingerprint; rows with a null key are grouped like others; no rows give no rows.
    """
    fps = store(fingerprints(docs, key, text, words), "simhash")
    named = classes(fps, {"component_id": F.col(key)}, bits).select("fp", "component_id")
    return fps.join(named, "fp").select(key, "fp", "component_id")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
               bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one of each near-duplicate class: the row of its smallest key.

    Rows are told apart by key and a hash of all columns, so rows of one key
    with different texts are decided each in its own class.  The rows without
    a key are decided among themselves: one of each class stays.  Texts move
    for the anti-join with the rows that go; of kept rows that repeat in every
    column one stays.
    """
    row = free_name("row", docs.columns)
    marked = docs.withColumn(row, F.xxhash64(*[x for c in docs.columns for x in (F.col(c), F.col(c).isNull())]))
    fps = store(fingerprints(marked, key, text, words, row), "simhash").toDF("key", "row", "fp")
    of = classes(fps, {"keyed": F.when(F.col("key").isNotNull(), F.struct("key", "row")),
                       "bare": F.when(F.col("key").isNull(), F.col("row"))}, bits).drop("component")
    stays = F.when(F.col("key").isNull(), F.col("row") == F.col("bare")).otherwise(F.struct("key", "row") == F.col("keyed"))
    decided = store(fps.join(of, "fp").select("key", "row", stays.alias("stays")), "simhash-decisions")

    def join(rows: DataFrame, some: DataFrame, how: str) -> DataFrame:
        return rows.join(some, rows[key].eqNullSafe(some["key"]) & (rows[row] == some["row"]), how)

    gone = decided.filter("not stays").select("key", "row").distinct()
    rest = join(marked, gone.toDF("key", "row"), "left_anti")
    repeated = decided.filter("stays").groupBy("key", "row").count().filter("count > 1").select("key", "row")
    if repeated.isEmpty():
        return rest.select(*docs.columns)
    once = join(rest, repeated, "left_semi").select(*docs.columns).distinct()
    return join(rest, repeated, "left_anti").select(*docs.columns).unionByName(once)


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
