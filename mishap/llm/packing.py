"""Operator 3: best-fit-decreasing packing of tokenized documents into windows."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from mishap.llm.common import Batches, chunks, free_name, map_batches, store, table, with_positions

WINDOW = 2048
END_ID = 1
CHUNK_BYTES = 1024 * 1024

def _byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible
    Latin-1 characters stand for themselves, the others for characters from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {**{chr(b): b for b in seen}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


class Ids:
    """Token ids of a byte-level vocabulary file, as the tokenizers library gives them.

    The file's vocabulary is merged by tiktoken, which gives the same ids some
    times faster; a text it can't split (very long runs of white space) goes to
    the tokenizers library itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        special = {t["content"]: t["id"] for t in found["added_tokens"]}
        value = _byte_values()
        ranks = {bytes(value[c] for c in token): k for token, k in found["model"]["vocab"].items() if token not in special}
        self.merger = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                        special_tokens=special)
        self.path = path

    def of(self, text: str) -> np.ndarray:
        try:
            return self.merger.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(Tokenizer.from_file(self.path).encode(text, add_special_tokens=False).ids, np.uint32)


_IDS: dict[str, Ids] = {}


def tokenize(docs: DataFrame, path: str | None = None, window: int = WINDOW, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """Token ids of every whole document with the end id, cut into pieces of at most ``window``.

    Returns key, start, length, doc_tokens and ids (little-endian unsigned
    32-bit).  Every document gives full windows and one rest, if any; a null or
    empty text is the end id alone.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    schema = T.StructType([docs.schema[key], T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("doc_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Batches) -> Batches:
        ids = _IDS.get(path) or _IDS.setdefault(path, Ids(path))
        for b in chunks(batches, text, CHUNK_BYTES):
            rows, starts, totals, parts = [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                own = np.append(ids.of(t or ""), END_ID).astype("<u4")
                for at in range(0, len(own), window):
                    rows.append(i)
                    starts.append(at)
                    totals.append(len(own))
                    parts.append(own[at:at + window].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int32())), pa.array(starts, pa.int64()),
                 pa.array([len(p) // 4 for p in parts], pa.int64()), pa.array(totals, pa.int64()),
                 pa.array(parts, pa.binary())], names=schema.names)

    return map_batches(docs.select(key, text), run, schema)


class Capacities:
    """Segment tree over remaining capacities: which of them open windows have."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, capacity: int, present: bool) -> None:
        at = self.leaves + capacity
        self.any[at] = present
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that an open window has."""
        at = self.leaves + least
        if self.any[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def plan(counts: Mapping[int, int], window: int = WINDOW) -> np.ndarray:
    """Best-fit decreasing over numbers of pieces by length.

    Pieces of one length are alike, and so are windows with the same room, so
    whole runs are placed at once; the plan's size follows the window's, not the
    corpus's.  Rows: length, first rank, number, first window, offset there,
    pieces a window takes in a row.
    """
    rules: list[tuple[int, ...]] = []
    tree, opened = Capacities(window), 0
    room: dict[int, list[tuple[int, int]]] = {}

    def put(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            room.setdefault(capacity, []).append((first, n))
            tree.set(capacity, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            free = tree.tightest(length)
            if free is None:
                free, each = window, window // length
                first, n = opened, -(-left // each)
                opened += n
            else:
                first, n = room[free].pop()
                if not room[free]:
                    tree.set(free, False)
                each = free // length
            whole = min(n, left // each)
            if whole:
                rules.append((length, rank, whole * each, first, window - free, each))
                put(free - each * length, first, whole)
                rank, left = rank + whole * each, left - whole * each
            if left and whole < n:                 # the last window takes what is left
                rules.append((length, rank, left, first + whole, window - free, each))
                put(free - left * length, first + whole, 1)
                whole, left = whole + 1, 0
            if free < window:
                put(free, first + whole, n - whole)
    return np.array(rules, np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, window: int = WINDOW, key: str = "doc_id") -> DataFrame:
    """Give every piece a sequence and an offset there; other columns are carried along.

    Pieces are ranked by length in one distributed order; the plan needs only
    how many there are of each length (at most ``window`` counts).  Equal
    pieces are placed one by one, null keys come first, no rows give no rows.
    """
    pieces = store(pieces, "pieces-unplaced")      # the order's sampling reads them once more
    carried = pieces.columns
    rank, at, shorter = (free_name(n, carried) for n in ("pos", "before", "shorter"))
    placed, _, _ = with_positions(pieces.withColumn(shorter, -F.col("length")), [shorter, key, "start"], "length",
                                  "pieces", rank, at)
    counts = {r["length"]: r["count"] for r in placed.groupBy("length").count().collect()}
    rules = plan(counts, window)
    first_of, seen = {}, 0
    for length in sorted(counts, reverse=True):
        first_of[length] = seen
        seen += counts[length]
    first_pos = np.array([first_of[int(r[0])] + r[1] for r in rules], np.int64)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(batches: Batches) -> Batches:
        for b in batches:
            pos = b.column(len(carried)).to_numpy()
            by = np.searchsorted(first_pos, pos, side="right") - 1
            rule, nth = rules[by], pos - first_pos[by]
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(carried))]
                + [pa.array(rule[:, 3] + nth // rule[:, 5]), pa.array(rule[:, 4] + nth % rule[:, 5] * rule[:, 0])],
                names=schema.names)

    return map_batches(placed.select(*carried, rank), place, schema)


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The packed sequences themselves: ids end to end, padded to the window
    unless their number is a power of two.  A group holds one window's pieces."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    size = F.col("tokens")
    whole = F.when((size.bitwiseAND(size - 1)) == 0, size).otherwise(F.lit(window))
    pad = F.lit(np.array([pad_id], "<u4").tobytes())
    return (packed.groupBy("sequence_id").agg(ordered.alias("pieces"), F.sum("length").alias("tokens"))
            .withColumn("ids", F.aggregate("pieces", F.lit(b""), lambda a, p: F.concat(a, p["ids"])))
            .withColumn("ids", F.rpad("ids", whole.cast("int") * 4, pad)).drop("pieces"))


def packed_digest(docs: DataFrame) -> DataFrame:
    """Tokenize and pack whole documents; ids are told by their checksum."""
    pieces = tokenize(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(table(spark, sf_dir, "documents").select("doc_id", "text"))
