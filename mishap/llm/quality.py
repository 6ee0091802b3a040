"""Operator 9: document quality by a regularised quadratic discriminant."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap.llm.common import Batches, chunks, free_name, map_batches, store, table, text_buffers
from mishap.llm.language_id import held_out

SHRINKAGE = 0.1
"""Weight of the pooled, then of the scaled unit covariance in each class's own."""
THRESHOLD = 0.7
CHUNK_BYTES = 1024 * 1024
"""Text described at once; a longer text is counted in pieces of this size."""

# Kinds of bytes that statistics count.
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 1                       # white space
_KIND[65:91] = 2                                         # A-Z
_KIND[97:123] = 3                                        # a-z
_KIND[128:] = 3                                          # parts of other characters
_KIND[48:58] = 4                                         # digits
_KIND[[33, 44, 46, 58, 59, 63, 39, 34, 45, 40, 41]] = 5  # usual punctuation
_MIX = np.uint64(0x9E3779B97F4A7C15)

STATISTICS = ("length", "capitals", "digits", "punctuation", "symbols", "spaces", "word_length", "bare_words",
              "marked_words", "repeated_words", "repeated_lines", "line_words", "exclamations")


# Usual shares, which stand in for as many counts as a short text lacks.
_USUAL_BYTES = {"capitals": 0.03, "digits": 0.005, "punctuation": 0.02, "symbols": 0.003, "spaces": 0.15}
_USUAL_WORDS = {"bare_words": 0.01, "marked_words": 0.01, "repeated_words": 0.2, "exclamations": 0.005}
BYTES, WORDS, LINES = 200, 30, 3


def _logit(part: np.ndarray, whole: np.ndarray, usual: float, weight: float) -> np.ndarray:
    """Log odds of a share, drawn to the usual share as by ``weight`` more counts."""
    part = part + usual * weight
    return np.log(part / (np.maximum(whole + weight - part, 0) + 0.01))


def _repeats(hashes: np.ndarray, home: np.ndarray, docs: int) -> np.ndarray:
    """Per document: members whose hash an earlier member of the document has."""
    order = np.lexsort([hashes, home])
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (home[order][1:] == home[order][:-1])
    return np.bincount(home[order][same], minlength=docs)


def _place_weights(since: np.ndarray) -> np.ndarray:
    """Odd, and in no line over the places, so that rearranged bytes differ."""
    with np.errstate(over="ignore"):
        w = (since.astype(np.uint64) + np.uint64(1)) * _MIX
        w ^= w >> np.uint64(32)
        w *= _MIX
        return w ^ (w >> np.uint64(29)) | np.uint64(1)


def _weights(starts: np.ndarray, size: int, before: int = 0) -> np.ndarray:
    """Of every byte, by its place since the last of ``starts`` (``before`` places stand before the first byte)."""
    starts = np.concatenate([[0], starts])               # what stands before the first is a run of its own
    since = np.arange(size) - np.repeat(starts, np.diff(np.concatenate([starts, [size]])))
    if before:
        since[:starts[1] if len(starts) > 1 else size] += before
    return _place_weights(since)


def _byte_values(data: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        step = (data.astype(np.uint64) + np.uint64(1)) * _MIX
        step ^= step >> np.uint64(29)
        return step


class _Runs:
    """Runs of marked bytes (words, lines) of one text that is read in pieces; a run may span any number of them."""

    def __init__(self) -> None:
        self.open: list[np.ndarray] | None = None        # sums of the run that the last piece left open

    def feed(self, mask: np.ndarray, step: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
        """Of every run that ends in this piece: hash, number of bytes, sums of ``counts``, and the byte after it."""
        size = len(mask)
        starts = np.flatnonzero(mask & np.concatenate([[self.open is None], ~mask[:-1]]))
        stops = np.flatnonzero(~mask & np.concatenate([[self.open is not None], mask[:-1]]))
        went_on = self.open is not None
        weights = _weights(starts, size, int(self.open[1]) if went_on else 0)
        begin, end = np.concatenate([[0], starts]) if went_on else starts, stops
        if len(end) < len(begin):
            end = np.concatenate([end, [size]])          # open at the piece's end
        out = []
        with np.errstate(over="ignore"):
            for k, value in enumerate((step * weights, np.ones(size, np.int64), *counts)):
                kind = np.uint64 if k == 0 else np.int64
                total = np.concatenate([np.zeros(1, kind), np.cumsum(value, dtype=kind)])
                part = total[end] - total[begin]
                if went_on:
                    part[0] += self.open[k]
                out.append(part)
        closed = len(stops)
        self.open = [x[closed] for x in out] if len(begin) > closed else None
        return [*(x[:closed] for x in out), stops]

    def finish(self) -> list[np.ndarray]:
        return [np.array([x]) for x in self.open] if self.open is not None else []


class _Distinct:
    """Number of different hashes, from sorted arrays that are merged as they grow alike."""

    def __init__(self) -> None:
        self.sorted: list[np.ndarray] = []

    def add(self, hashes: np.ndarray) -> None:
        self.sorted.append(np.unique(hashes))
        while len(self.sorted) > 1 and len(self.sorted[-2]) < 2 * len(self.sorted[-1]):
            self._merge()

    def _merge(self) -> None:
        last = self.sorted.pop()
        self.sorted[-1] = np.unique(np.concatenate([self.sorted[-1], last]))

    def count(self) -> int:
        while len(self.sorted) > 1:
            self._merge()
        return len(self.sorted[0]) if self.sorted else 0


def long_statistics(data: np.ndarray, piece: int = CHUNK_BYTES) -> np.ndarray:
    """The statistics of one text, equal to those of ``statistics``, from pieces: all it counts adds up.

    Memory grows with the piece and the text's different words and lines only.
    """
    kinds, loud, words, lines, bare, marked = np.zeros(6, np.int64), 0, 0, 0, 0, 0
    word_runs, line_runs, word_kinds, line_kinds = _Runs(), _Runs(), _Distinct(), _Distinct()
    ending = _byte_values(np.array([13], np.uint8))[0]
    before = 0                                           # the byte before the piece
    for at in range(0, len(data), piece):
        part = data[at:at + piece]
        kind, step = _KIND[part], _byte_values(part)
        kinds += np.bincount(kind, minlength=6)
        loud += int((part == 33).sum())
        found = word_runs.feed(kind != 1, step, (kind == 2) | (kind == 3), kind == 0)
        ends = [found[:4]]
        lined = line_runs.feed(part != 10, step)
        hashes, size, stops = lined
        last = np.where(stops > 0, part[stops - 1], before)
        with np.errstate(over="ignore"):                 # a line's closing \r is no part of it
            hashes = np.where(last == 13, hashes - ending * _place_weights(np.maximum(size - 1, 0)), hashes)
        line_hashes = [hashes]
        before = int(part[-1])
        if at + piece >= len(data):
            if left := word_runs.finish():
                ends.append(left)
            if left := line_runs.finish():
                line_hashes.append(left[0])
        for hashes, _, letters, odd in ends:
            words, bare, marked = words + len(hashes), bare + int((letters == 0).sum()), marked + int((odd > 0).sum())
            word_kinds.add(hashes)
        for hashes in line_hashes:
            lines += len(hashes)
            line_kinds.add(hashes)
    other, space, upper, lower, digit, mark = kinds
    return _transformed(*(np.array([x], np.float64) for x in (
        len(data), upper, lower, digit, mark, other, space, loud, words, bare, marked, words - word_kinds.count(),
        lines, lines - line_kinds.count())))


def _transformed(n, upper, lower, digit, mark, other, space, loud, words, bare, marked, again, lines, line_again) -> np.ndarray:
    usual, by_word = _USUAL_BYTES, _USUAL_WORDS
    return np.stack([
        np.log(n + BYTES), _logit(upper, upper + lower, usual["capitals"], BYTES), _logit(digit, n, usual["digits"], BYTES),
        _logit(mark, n, usual["punctuation"], BYTES), _logit(other, n, usual["symbols"], BYTES),
        _logit(space, n, usual["spaces"], BYTES), np.log((n - space + 6 * WORDS) / (words + WORDS)),
        _logit(bare, words, by_word["bare_words"], WORDS), _logit(marked, words, by_word["marked_words"], WORDS),
        _logit(again, words, by_word["repeated_words"], WORDS), _logit(line_again, lines, 0.05, LINES),
        np.log((words + 20 * LINES) / (lines + LINES)), _logit(loud, words, by_word["exclamations"], WORDS),
    ], axis=1)


def statistics(column: pa.Array) -> np.ndarray:
    """One row of transformed statistics for every whole text (a null text is empty)."""
    data, offsets = text_buffers(column)
    docs, n = len(offsets) - 1, np.diff(offsets)
    if not len(data):
        data = np.zeros(1, np.uint8)
    kind = _KIND[data]
    home = np.repeat(np.arange(docs), n)

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(np.float64)

    space, upper, lower, digit, mark, other = (count(kind == k) for k in (1, 2, 3, 4, 5, 0))
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    visible = kind != 1
    start = visible & (np.concatenate([[True], ~visible[:-1]]) | cut[:-1])
    stop = visible & (np.concatenate([~visible[1:], [True]]) | cut[1:])
    first, last = np.flatnonzero(start), np.flatnonzero(stop)
    if not len(home):
        first, last = first[:0], last[:0]
    word_home = home[first]
    words = np.bincount(word_home, minlength=docs).astype(np.float64)
    letters = np.concatenate([[0], np.cumsum((kind == 2) | (kind == 3))])
    inside = letters[last + 1] - letters[first]
    bare = np.bincount(word_home[inside == 0], minlength=docs)
    odd = np.concatenate([[0], np.cumsum(kind == 0)])
    marked = np.bincount(word_home[odd[last + 1] > odd[first]], minlength=docs)
    step = _byte_values(data)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(step * _weights(first, len(data)), dtype=np.uint64)])
    again = _repeats(sums[last + 1] - sums[first], word_home, docs)
    new = data == 10
    opens = np.concatenate([[True], new[:-1]]) | cut[:-1]
    begin = np.flatnonzero(opens & ~new)
    if not len(home):
        begin = begin[:0]
    end = np.concatenate([np.flatnonzero(new | np.concatenate([cut[1:-1], [True]])), [len(data) - 1]])
    finish = end[np.searchsorted(end, begin)]
    line_home = home[begin]
    lines = np.bincount(line_home, minlength=docs).astype(np.float64)
    stop = finish + 1 - new[finish]                      # the closing line break is no part of a line
    stop = stop - (new[finish] & (data[stop - 1] == 13) & (stop > begin))
    with np.errstate(over="ignore"):
        bytes_ = np.concatenate([np.zeros(1, np.uint64), np.cumsum(step * _weights(begin, len(data)), dtype=np.uint64)])
        line_again = _repeats(bytes_[stop] - bytes_[begin], line_home, docs)
    loud = count(data == 33)
    return _transformed(n, upper, lower, digit, mark, other, space, loud, words, bare, marked, again, lines, line_again)


@dataclass
class Discriminant:
    """Class means, log priors and cached Cholesky factors of the shrunk covariances."""
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    @classmethod
    def from_moments(cls, moments: np.ndarray, shrinkage: float = SHRINKAGE) -> Discriminant | None:
        """Of the classes' sums: count, sums and products (2 x (1 + d + d*d)); None unless both have rows."""
        d = int((np.sqrt(4 * moments.shape[1] - 3) - 1) / 2)
        count, sums, products = moments[:, 0], moments[:, 1:1 + d], moments[:, 1 + d:].reshape(2, d, d)
        if (count < 1).any():
            return None
        total = count.sum()
        centre = sums.sum(axis=0) / total
        spread = np.diag(products.sum(axis=0)) / total - centre ** 2
        scale = np.sqrt(np.maximum(spread, 1e-6))
        raw = sums / count[:, None]
        own = products / count[:, None, None] - raw[:, :, None] * raw[:, None, :]
        own = own / scale[None, :, None] / scale[None, None, :]
        pooled = (own * count[:, None, None]).sum(axis=0) / total
        shrunk = (1 - shrinkage) * own + shrinkage * pooled
        unit = np.trace(shrunk, axis1=1, axis2=2)[:, None, None] / d * np.eye(d)
        shrunk = (1 - shrinkage) * shrunk + shrinkage * unit + 1e-6 * np.eye(d)
        factors = np.linalg.cholesky(shrunk)
        logdet = 2 * np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1)
        return cls(centre, scale, (raw - centre) / scale, np.linalg.inv(factors), np.log(count / total) - logdet / 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1: the logistic of the log-density difference."""
        x = (x - self.centre) / self.scale
        logs = [c - (((x - m) @ f.T) ** 2).sum(axis=1) / 2
                for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def describe(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """The rows without their texts, with the statistics of every whole text (the new column's name comes back too)."""
    kept = [c for c in docs.columns if c != text]
    name = free_name("statistics", kept)
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])

    def run(batches: Batches) -> Batches:
        for b in chunks(batches, text, CHUNK_BYTES):
            data, offsets = text_buffers(b.column(len(kept)))
            x = statistics(b.column(len(kept))) if len(offsets) > 2 or len(data) <= CHUNK_BYTES else long_statistics(data)
            ends = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(x.ravel()))],
                                             names=schema.names)

    return map_batches(docs.select(*kept, text), run, schema), name


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit(described: DataFrame, labels: DataFrame, key: str = "doc_id", name: str = "statistics",
        label: str = "quality") -> Discriminant | None:
    """Fit to the statistics of all labelled rows that are not held out: tasks send sums, never rows.

    Repeated labels of an id count once each; ids with a null or other label are left out.
    """
    marked = labels.filter(F.col(label).isin(0, 1)).select(F.col(key), F.col(label).cast("int").alias("class_"))
    rows = (described.select(key, name).join(marked, key).filter(~held_out(F.col(key))).select("class_", name))

    def sums(batches: Batches) -> Batches:
        total = 0
        for b in batches:
            if b.num_rows:
                y, x = b.column(0).to_numpy(), _matrix(b.column(1))
                total = total + np.stack([np.concatenate([
                    [(y == k).sum()], x[y == k].sum(axis=0), (x[y == k].T @ x[y == k]).ravel()]) for k in (0, 1)])
        if np.ndim(total):
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)],
                                             names=["at", "value"])

    found = map_batches(rows, sums, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    if not found:
        return None
    flat = np.zeros(len(found))
    for r in found:
        flat[r["at"]] = r["value"]
    return Discriminant.from_moments(flat.reshape(2, -1))


def score_quality(described: DataFrame, model: Discriminant | None, name: str = "statistics") -> tuple[DataFrame, str]:
    """The described rows with their score instead of the statistics (the new column's name comes back too).

    Null and empty texts are scored like any other; 0.5 where nothing was learned.
    """
    kept = [c for c in described.columns if c != name]
    score = free_name("score", kept)
    if model is None:
        return described.select(*kept, F.lit(0.5).alias(score)), score
    schema = T.StructType([*described.select(*kept).schema.fields, T.StructField(score, T.DoubleType())])

    def run(batches: Batches) -> Batches:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(model.score(_matrix(b.column(len(kept)))))],
                                                 names=schema.names)

    return map_batches(described.select(*kept, name), run, schema), score


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    described, _ = describe(table(spark, sf_dir, "documents").select("doc_id", "text"))
    described = store(described, "quality-statistics")
    scored, _ = score_quality(described, fit(described, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
