"""Operator 13: alignment of two tokenizers' tokens by pointer jumping over their overlaps."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from mishap.llm.common import Batches, chunks, map_batches, store, table, text_buffers
from mishap.llm.packing import Ids
from mishap.llm.sentencepieces import MARK, MODEL, Pieces, pieces_of

VOCABULARY = "byte_bpe_50k.json"
CHUNK_BYTES = 1024 * 1024
PIECE_TOKENS = 1_000_000
"""Tokens are aligned in pieces of whole parts; a piece ends with the part that takes it over so many A tokens."""
BLOCK_DOCS, BLOCK_BYTES = 8192, 8 * 1024 * 1024
"""A block holds the pairs of so many documents and bytes of text at most (or of one document)."""


class Pair:
    """The two tokenizers with the bytes of their tokens: A byte-level BPE of space and text, B pieces of the text."""

    def __init__(self, a_path: str, b_path: str):
        self.a_path, self.a, self.b = a_path, Ids(a_path), pieces_of(b_path)
        size = self.a.merger.max_token_value + 1
        self.a_length = np.array([len(self.a.merger.decode_single_token_bytes(k)) for k in range(size)])
        self.b_length = np.array([len(s) for s in self.b.surface])
        self.texts = [_separated(size, b";"), _separated(size, b","), _separated(len(self.b_length), b"|"),
                      _separated(len(self.b_length), b",")]

    def _a_ids(self, text: str) -> np.ndarray:
        try:
            return np.array(self.a.merger.encode_ordinary(text), np.int64)
        except ValueError:                           # very long runs of white space
            slow = Tokenizer.from_file(self.a_path)
            slow.encode_special_tokens = True
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.int64)

    def _part(self, data: np.ndarray, at: int, to: int) -> tuple[bytes, bytes]:
        """The bytes that A encodes and those that B does (with its mark for a space) of a part of a text."""
        whole = data[at:to].tobytes() if at else b" " + data[at:to].tobytes()
        return whole, self.b.normalise(data[at:to], at == 0, to == len(data)).data.tobytes()

    def tokens(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """A and B ids of a text, part by part; none if either tokenizer's bytes differ from space and text.

        Parts of a very long text are cut before a single space between ASCII
        letters or digits, where tokens of both end.
        """
        parts = list(self.b.parts(data)) if len(data) else []
        mark = MARK.encode()
        if len(parts) > 1 and any(normal.replace(mark, b" ") != whole for whole, normal in (self._part(data, *p) for p in parts)):
            return
        for at, to in parts:
            whole, normal = self._part(data, at, to)
            if normal.replace(mark, b" ") == whole:
                yield self._a_ids(whole.decode("utf-8", "replace")), self.b.ids(normal.decode("utf-8", "replace")).astype(np.int64)


def _separated(size: int, mark: bytes) -> np.ndarray:
    return np.array([mark + str(k).encode() for k in range(size)], object)


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(a_path: str, b_path: str) -> Pair:
    key = a_path, b_path
    return _PAIRS.get(key) or _PAIRS.setdefault(key, Pair(*key))


@dataclass
class Aligned:
    """Tokens of many texts end to end, with the groups that their overlaps connect."""
    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    low: np.ndarray                                  # of every B token: the first and last A token it overlaps
    high: np.ndarray

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray, a_length: np.ndarray, b_length: np.ndarray) -> Aligned:
        """Every token points to the farthest-right token it overlaps, which is that of the other
        tokenizer over its last byte if that one ends no earlier (ties: the B token, which then
        points to itself).  Doubling the successors until nothing changes leaves each token
        pointing to the last token of its component, the group's label.  Texts end both
        tokenizers' tokens, so components stay inside a text."""
        a_end, b_end = np.cumsum(a_length[a]), np.cumsum(b_length[b])
        over_a = np.searchsorted(b_end, a_end)       # the B token over A's last byte
        over_b = np.searchsorted(a_end, b_end)
        own = len(a) + np.arange(len(b))
        farther = a_end[over_b] > b_end
        successor = np.concatenate([len(a) + over_a, np.where(farther, over_b, own)])
        while True:
            jumped = successor[successor]
            if (jumped == successor).all():
                break
            successor = jumped
        number = np.cumsum(~farther) - 1
        group = number[successor - len(a)]
        return cls(a, b, group[:len(a)], group[len(a):], np.searchsorted(a_end, b_end - b_length[b], "right"), over_b)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """All overlapping occurrences: A and B positions."""
        n = self.high - self.low + 1
        b = np.repeat(np.arange(len(self.b)), n)
        return np.arange(len(b)) - np.repeat(np.cumsum(n) - n - self.low, n), b

    def written(self, texts: Sequence[np.ndarray]) -> np.ndarray:
        """All tokens' ids with their separators in reading order (A before B in a group)."""
        groups = int(self.b_group[-1]) + 1 if len(self.b) else 0
        first_b = np.searchsorted(self.b_group, np.arange(groups))
        after_a = np.searchsorted(self.a_group, np.arange(groups), "right")
        out = np.empty(len(self.a) + len(self.b), object)
        opens_a = np.concatenate([[True], self.a_group[1:] != self.a_group[:-1]])[:len(self.a)]
        opens_b = np.concatenate([[True], self.b_group[1:] != self.b_group[:-1]])[:len(self.b)]
        at_a, at_b = np.arange(len(self.a)) + first_b[self.a_group], np.arange(len(self.b)) + after_a[self.b_group]
        for at, ids, opens, (one, more) in ((at_a, self.a, opens_a, texts[:2]), (at_b, self.b, opens_b, texts[2:])):
            out[at[opens]] = one[ids[opens]]
            out[at[~opens]] = more[ids[~opens]]
        return out


def _texts_of(pair: Pair, batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, list[np.ndarray], Aligned]]:
    """The texts' parts in pieces of bounded size: of which row each is, where its tokens start, and all tokens aligned."""
    data, offsets = text_buffers(batch.column(column))
    none = np.zeros(0, np.int64)

    def piece() -> tuple[np.ndarray, list[np.ndarray], Aligned]:
        aligned = Aligned.of(np.concatenate([none, *[p[0] for _, p in parts]]), np.concatenate([none, *[p[1] for _, p in parts]]),
                             pair.a_length, pair.b_length)
        starts = [np.cumsum([0, *[len(p[k]) for _, p in parts]]) for k in (0, 1)]
        return np.array([row for row, _ in parts], np.int64), starts, aligned

    parts, held = [], 0
    for row, (i, k) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        for p in pair.tokens(data[i:k]):
            parts.append((row, p))
            held += len(p[0])
            if held > PIECE_TOKENS:
                yield piece()
                parts, held = [], 0
    yield piece()


def _first_of(home: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run of equal rows: how many groups come before it, and its length."""
    opens = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1]])[:len(home)])
    return (np.cumsum(number) - number)[opens], np.diff(np.append(opens, len(home)))


def _sums(values: np.ndarray, starts: np.ndarray, home: np.ndarray, rows: int) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return np.bincount(home, total[starts[1:]] - total[starts[:-1]], rows).astype(np.int64)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Every text's tokens with their groups: ``a_ids``, ``a_groups``, ``b_ids``, ``b_groups`` (groups from 0 in each text).

    Texts without tokens (null, empty, or where a tokenizer's bytes differ from
    space and text) have empty lists.  Only key and text are read; repeated
    rows and null keys stay.
    """
    paths = a_path or public_tokenizers.path(VOCABULARY), b_path or public_tokenizers.path(MODEL)
    lists = T.ArrayType(T.IntegerType())
    schema = T.StructType([docs.schema[key], *[T.StructField(n, lists) for n in ("a_ids", "a_groups", "b_ids", "b_groups")]])

    def run(batches: Batches) -> Batches:
        pair = pair_of(*paths)
        for b in chunks(batches, text, CHUNK_BYTES):
            ids, groups, rows = [[], []], [[], []], [[], []]
            seen = np.zeros(b.num_rows, np.int64)                  # groups of each text's parts so far
            for home, starts, found in _texts_of(pair, b, 1):
                for k, (own, group) in enumerate(((found.a, found.a_group), (found.b, found.b_group))):
                    n = np.diff(starts[k])
                    first = np.append(found.b_group, 0)[starts[1][:-1]]
                    number = np.diff(np.append(first, found.b_group[-1] + 1 if len(found.b) else 0))
                    after = np.cumsum(number) - number - np.repeat(*_first_of(home, number))
                    ids[k].append(own)
                    groups[k].append(group + np.repeat(seen[home] + after - first, n))
                    rows[k].append(np.repeat(home, n))
                seen += np.bincount(home, number, b.num_rows).astype(np.int64) if len(home) else 0
            columns = []
            for k in (0, 1):
                ends = np.cumsum(np.concatenate([[0], np.bincount(np.concatenate(rows[k]), minlength=b.num_rows)]))
                columns += [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(x).astype(np.int32)))
                            for x in (ids[k], groups[k])]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=schema.names)

    return map_batches(docs.select(key, text), run, schema)


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest needs."""
    most = int(values.max()) if len(values) else 0
    return values.astype(np.min_scalar_type(most).newbyteorder("<")).tobytes()


def _wide(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, f"<u{len(blob) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def blocks(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of aligned documents: figures of each document, the block's distinct id pairs (A id times the size
    of B's vocabulary, plus B id) with their links, and which pairs each document has how often."""
    longs = T.ArrayType(T.LongType())
    own = [T.StructField(n, longs) for n in ("n_a", "n_b", "n_groups", "n_links")]
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("docs", T.ArrayType(docs.schema[key].dataType)),
                           *own, T.StructField("sha256", T.ArrayType(T.StringType())), T.StructField("kinds", longs),
                           T.StructField("at", T.BinaryType()), T.StructField("times", T.BinaryType()),
                           T.StructField("pairs", longs), T.StructField("links", longs)])
    most_docs, most_bytes = BLOCK_DOCS, BLOCK_BYTES

    def run(batches: Batches) -> Batches:
        pair = pair_of(a_path, b_path)
        size = len(pair.b_length)
        span = len(pair.a_length) * size
        made, held, parts, key_kind = 0, [0, 0], [], pa.null()

        def one(b: pa.RecordBatch) -> tuple:
            n = b.num_rows
            figures = np.zeros((4, n), np.int64)
            pairs, digests = [], [None] * n
            for home, (a_starts, b_starts), found in _texts_of(pair, b, 1):
                opens = np.concatenate([[1], found.b_group[1:] != found.b_group[:-1]])[:len(found.b)]
                figures += [_sums(values, starts, home, n) for values, starts in (
                    (np.ones(len(found.a), np.int64), a_starts), (np.ones(len(found.b), np.int64), b_starts), (opens, b_starts),
                    (found.high - found.low + 1, b_starts))]
                a_at, b_at = found.links()
                doc = np.repeat(home, np.diff(b_starts))[b_at] if len(home) else b_at
                pairs.append(np.unique(doc * span + found.a[a_at] * size + found.b[b_at], return_counts=True))
                out = found.written(pair.texts)
                ends = a_starts + b_starts
                for row, i, k in zip(home.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    piece = b"".join(out[i:k].tolist())
                    if digests[row] is None:
                        digests[row], piece = hashlib.sha256(), piece[1:]
                    digests[row].update(piece)
            kinds, times = pairs[0]
            if len(pairs) > 1:                       # a text in several pieces: its pairs once
                kinds, at = np.unique(np.concatenate([p[0] for p in pairs]), return_inverse=True)
                times = np.bincount(at, np.concatenate([p[1] for p in pairs])).astype(np.int64)
            return (b.column(0).to_pylist(), *figures, [d.hexdigest() if d else "" for d in digests],
                    np.bincount(kinds // span, minlength=n), kinds % span, times)

        def block() -> pa.RecordBatch:
            kinds, times = np.concatenate([p[7] for p in parts]), np.concatenate([p[8] for p in parts])
            pairs, at = np.unique(kinds, return_inverse=True)
            links = np.bincount(at, times, len(pairs)).astype(np.int64)
            values = [(TaskContext.get().partitionId() << 33) + made, [k for p in parts for k in p[0]],
                      *[np.concatenate([p[c] for p in parts]).tolist() for c in range(1, 5)],
                      [d for p in parts for d in p[5]], np.concatenate([p[6] for p in parts]).tolist(),
                      _narrow(at), _narrow(times), pairs, links]
            kind = [pa.int64(), pa.list_(key_kind), *[pa.list_(pa.int64())] * 4, pa.list_(pa.string()), pa.list_(pa.int64()),
                    pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kind, strict=True)], names=schema.names)

        for b in chunks(batches, text, CHUNK_BYTES):
            key_kind = b.schema.field(0).type
            for at in range(0, b.num_rows, most_docs):
                piece = b.slice(at, most_docs)
                n, nbytes = piece.num_rows, len(text_buffers(piece.column(1))[0])
                if parts and (held[0] + n > most_docs or held[1] + nbytes > most_bytes):
                    yield block()
                    made, held, parts = made + 1, [0, 0], []
                parts.append(one(piece))
                held = [held[0] + n, held[1] + nbytes]
        if parts:
            yield block()

    return map_batches(docs.select(key, text), run, schema)


def pair_counts(found: DataFrame, b_size: int) -> DataFrame:
    """Links of every id pair in the whole corpus, and whether no pair of the same B id has more.

    Blocks send their distinct pairs only; the pairs of a B id are as many as A has ids at most.
    """
    sent = found.select(F.inline(F.arrays_zip("pairs", "links")))
    counts = sent.groupBy("pairs").agg(F.sum("links").alias("count")).withColumnRenamed("pairs", "pair")
    most = F.max("count").over(Window.partitionBy(F.pmod("pair", F.lit(b_size))))
    return counts.withColumn("best", F.col("count") == most)


def alignment_figures(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """Per document: tokens, groups and links, how many links are their B id's commonest pair, and their counts' sum.

    Texts are tokenized and aligned once, block by block, and stored; id pairs
    are counted over all blocks, and a block then gets the counts of its own
    distinct pairs, whatever the number of its links.  Nothing of the size of
    the corpus or of the pair table is broadcast.

    One row per row of ``docs``; null and empty texts and those that a
    tokenizer changes have zeros and an empty checksum.  Null keys and
    repeated rows stay, an empty table gives no rows, other columns are not
    read.
    """
    a_path, b_path = a_path or public_tokenizers.path(VOCABULARY), b_path or public_tokenizers.path(MODEL)
    found = store(blocks(docs, a_path, b_path, key, text), "alignment-blocks")
    counts = pair_counts(found, len(Pieces(b_path).length))
    answers = found.select(F.col("block").alias("home"), F.explode("pairs").alias("pair")).join(counts, "pair")
    figures = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    schema = T.StructType([docs.schema[key], *[T.StructField(n, T.LongType()) for n in figures],
                           T.StructField("groups_sha256", T.StringType())])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {n: left.column(n)[0] for n in left.column_names}
        values = {n: row[n].values.to_numpy(zero_copy_only=False).astype(np.int64) for n in ("kinds", *figures[:4])}
        order = np.argsort(right.column("pair").to_numpy())
        count = right.column("count").to_numpy()[order]
        best = right.column("best").to_numpy()[order]
        n = int(values["kinds"].sum())
        at, times = _wide(row["at"].as_py(), n), _wide(row["times"].as_py(), n)
        ends = np.cumsum(np.concatenate([[0], values["kinds"]]))
        for name, each in (("n_best", times * best[at]), ("count_sum", times * count[at])):
            total = np.concatenate([[0], np.cumsum(each)])
            values[name] = total[ends[1:]] - total[ends[:-1]]
        return pa.Table.from_arrays([row["docs"].values, *[pa.array(values[n]) for n in figures], row["sha256"].values],
                                    names=schema.names)

    kept = found.select("block", "docs", *figures[:4], "sha256", "kinds", "at", "times")
    return kept.groupBy("block").cogroup(answers.groupBy("home")).applyInArrow(finish, schema)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_figures(table(spark, sf_dir, "documents").select("doc_id", "text"))
