"""Operator 7: benchmark decontamination with suffix arrays over the training texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap.llm.common import Batches, chunks, free_name, map_batches, store, table, text_buffers

WINDOW = 10
SHARD_BYTES = 1024 * 1024
"""Text under one suffix array; a longer document is cut into overlapping shards."""
BLOCK_BYTES = 8 * 1024 * 1024
"""Benchmark text that one pass searches for; a larger benchmark takes several passes."""
ROWS_AT_ONCE = 1 << 17

# Bytes of words: digits, letters and all bytes of characters beyond ASCII; A-Z is lower-cased.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_OF_WORD = _IN_WORD[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_VALUES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(0xA0761D6478BD642F)


def _powers(n: int, base: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)


_POWER = _powers(1 << 16, _BASE)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BACK = _powers(1 << 16, _INVERSE)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWER, _BACK
    if n >= len(_POWER):
        _POWER, _BACK = _powers(2 * n, _BASE), _powers(2 * n, _INVERSE)
    return _POWER, _BACK


@dataclass
class Words:
    """Words of a batch of texts: byte ranges, hashes, and each text's first word."""
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def split_words(column: pa.Array) -> Words:
    """Lower-cased words of every text; words never run over the end of a text."""
    return _split(*text_buffers(column))


def _split(raw: np.ndarray, offsets: np.ndarray) -> Words:
    data = _LOWER[raw]
    word = _IN_WORD[data]
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begin[inner] |= word[inner]
    end[inner - 1] |= word[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    power, back = _tables(len(data))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[data] * power[:len(data)], dtype=np.uint64)])
        hashes = (sums[ends] - sums[starts]) * back[starts]
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def _split_parts(texts: list[str]) -> Words:
    """``split_words`` of a list, a shard of text at a time."""
    parts, data, word = [], 0, 0
    column = pa.array(texts, pa.string())
    for b in chunks(iter([pa.RecordBatch.from_arrays([column], names=["text"])]), "text", SHARD_BYTES):
        w = split_words(b.column(0))
        parts.append(Words(w.data, w.starts + data, w.ends + data, w.hashes, w.first[:-1] + word))
        data, word = data + len(w.data), word + len(w.hashes)
    joined = [np.concatenate([getattr(p, n) for p in parts] or [np.zeros(0, kind)]) for n, kind in (
        ("data", np.uint8), ("starts", np.int64), ("ends", np.int64), ("hashes", np.uint64), ("first", np.int64))]
    return Words(*joined[:4], np.concatenate([joined[4], [word]]))


class Tests:
    """One block of benchmark items, ready for searching: vocabulary, windows and their items, all as arrays.

    A window is a row of word ids packed into as few longs as they fit; a short
    one is filled up with zeros.  ``item`` and ``word`` are the places of all
    windows, those of window ``k`` from ``bounds[k]`` to ``bounds[k + 1]``.
    """

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window, self.names = window, [n for n, _ in items]
        w = _split_parts([t for _, t in items])
        self.vocabulary, at, ids = np.unique(w.hashes, return_index=True, return_inverse=True)
        self.data, self.spelled = w.data, (w.starts[at], w.ends[at])
        self.longest_word = int((w.ends - w.starts).max(initial=0))
        self.width = max(1, int(len(self.vocabulary)).bit_length())
        self.per_key = 63 // self.width
        count = np.diff(w.first)
        each = np.where(count > 0, np.maximum(count - window + 1, 1), 0)
        item = np.repeat(np.arange(len(items)), each)
        word = np.arange(len(item)) - np.repeat(np.cumsum(each) - each, each)
        ids = np.concatenate([ids + 1, np.zeros(window, np.int64)])
        start, lengths = w.first[item] + word, np.minimum(count[item], window)
        low = self._packed(ids, start, lengths)
        order = np.lexsort(low[::-1])
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in low])
        first = np.flatnonzero(new)
        self.low, self.lengths = [k[order][first] for k in low], lengths[order][first]
        self.item, self.word = item[order], word[order]
        self.bounds = np.concatenate([first, [len(order)]])
        full = [self.keys((np.arange(window) >= n)[None, :] * ((1 << self.width) - 1)) for n in range(window + 1)]
        self.fill = [np.array([f[k][0] for f in full]) for k in range(len(low))]
        self.least = int(self.lengths.min(initial=0)) if len(first) else 0

    def _packed(self, ids: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Keys of the words from ``start`` on, beyond ``lengths`` filled up with zeros."""
        parts, at = [], np.arange(self.window)[None, :]
        for k in range(0, max(len(start), 1), ROWS_AT_ONCE):
            rows = ids[start[k:k + ROWS_AT_ONCE, None] + at]
            parts.append(self.keys(np.where(at < lengths[k:k + ROWS_AT_ONCE, None], rows, 0)))
        return [np.concatenate(x) for x in zip(*parts, strict=True)]

    def high(self, k: int, windows: np.ndarray | int) -> np.ndarray:
        """The last key that begins with a window's words."""
        return self.low[k][windows] | self.fill[k][self.lengths[windows]]

    def spelling(self, word: int) -> bytes:
        return self.data[self.spelled[0][word]:self.spelled[1][word]].tobytes()

    def keys(self, words: np.ndarray) -> list[np.ndarray]:
        """Rows of word ids packed in order into as few longs as they fit."""
        out = []
        for at in range(0, self.window, self.per_key):
            key = np.zeros(len(words), np.int64)
            for k in range(at, min(at + self.per_key, self.window)):
                key = (key << self.width) | words[:, k]
            out.append(key)
        return out


class SuffixArray:
    """Suffixes of the words of a shard, sorted by their first ``window`` words.

    Suffixes that begin with fewer benchmark words than the shortest window has
    match no window and are left out.  Words that no item has end a suffix.
    """

    def __init__(self, words: Words, tests: Tests):
        n = len(words.hashes)
        spot = np.searchsorted(tests.vocabulary, words.hashes)
        spot[spot == len(tests.vocabulary)] = 0
        ids = np.where(tests.vocabulary[spot] == words.hashes, spot + 1, 0)
        stops = np.zeros(n + 1, bool)
        stops[words.first] = True
        stops[:-1] |= ids == 0
        at = np.where(stops, np.arange(n + 1), n)
        self.stop = np.minimum.accumulate(at[::-1])[::-1]           # next stop at or after a word
        after = np.concatenate([self.stop[1:], [n]])[:n]            # a text's first word is a stop itself
        room = np.where(ids > 0, after - np.arange(n), 0)
        self.ids = ids
        spots = np.flatnonzero(room >= tests.least)
        room = np.minimum(room[spots], tests.window)
        keys = tests._packed(np.concatenate([ids, np.zeros(tests.window, np.int64)]), spots, room)
        order = np.lexsort(keys[::-1])
        self.spots, self.keys = spots[order], [k[order] for k in keys]

    def find(self, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
        """(position, window) of every occurrence, by binary search of every test suffix."""
        lo = np.searchsorted(self.keys[0], tests.low[0], side="left")
        hi = np.searchsorted(self.keys[0], tests.high(0, slice(None)), side="right")
        spots, found = [], []
        for w in np.flatnonzero(hi > lo):
            a, b = int(lo[w]), int(hi[w])
            for k in range(1, len(self.keys)):
                if a < b and self.keys[k - 1][a] == self.keys[k - 1][b - 1]:
                    part = self.keys[k][a:b]
                    a, b = a + int(np.searchsorted(part, tests.low[k][w], side="left")), \
                        a + int(np.searchsorted(part, tests.high(k, w), side="right"))
            if a < b:
                spots.append(self.spots[a:b])
                found.append(np.full(b - a, w))
        if not spots:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(spots), np.concatenate(found)


@dataclass
class Matches:
    """Per text: number of words, ranges of hit words, longest verbatim match, item names."""
    words: np.ndarray
    firsts: list[list[int]]
    lengths: list[list[int]]
    longest: np.ndarray
    items: list[list[str]]


def find_matches(column: pa.Array, tests: Tests, shard: int = SHARD_BYTES) -> Matches:
    """The matches of every text; a text of over ``shard`` bytes is searched shard by shard."""
    raw, offsets = text_buffers(column)
    if len(column) == 1 and len(raw) > shard:
        first, spots, found = _find_long(raw, tests, shard)
    else:
        words = _split(raw, offsets)
        first, (spots, found) = words.first, _occurrences(words, tests)
    count = np.diff(first)
    out = Matches(count, [[] for _ in count], [[] for _ in count], np.zeros(len(count), np.int64), [[] for _ in count])
    if not len(spots):
        return out
    # ranges of hit words, cut where a text begins
    order = np.argsort(spots, kind="stable")
    begin, reach = spots[order], np.maximum.accumulate((spots + tests.lengths[found])[order])
    home = np.searchsorted(first, begin, side="right") - 1
    fresh = np.concatenate([[True], (begin[1:] > reach[:-1]) | (home[1:] != home[:-1])])
    begin, home, stop = begin[fresh], home[fresh], reach[np.concatenate([np.flatnonzero(fresh)[1:], [len(reach)]]) - 1]
    for d, a, b in zip(home.tolist(), begin.tolist(), stop.tolist(), strict=True):
        out.firsts[d].append(a - int(first[d]))
        out.lengths[d].append(b - a)
    # consecutive windows of one item at consecutive words are one longer match
    each = tests.bounds[found + 1] - tests.bounds[found]
    at = np.arange(each.sum()) + np.repeat(tests.bounds[found] - (np.cumsum(each) - each), each)
    item, word, size = tests.item[at], np.repeat(spots, each), np.repeat(tests.lengths[found], each)
    order = np.lexsort([word, word - tests.word[at], item])
    item, word, size, shift = item[order], word[order], size[order], (word - tests.word[at])[order]
    fresh = np.concatenate([[True], (item[1:] != item[:-1]) | (shift[1:] != shift[:-1]) | (word[1:] != word[:-1] + 1)])
    run = np.flatnonzero(fresh)
    ends = np.concatenate([run[1:], [len(word)]]) - 1
    doc = np.searchsorted(first, word, side="right") - 1
    np.maximum.at(out.longest, doc[run], word[ends] + size[ends] - word[run])
    pairs = np.unique(np.stack([doc, item], axis=1), axis=0)
    for d, k in pairs.tolist():
        out.items[d].append(tests.names[k])
    out.items = [sorted(set(x)) for x in out.items]
    return out


def _occurrences(words: Words, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    if not len(tests.lengths) or not len(words.hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _verified(words, tests, *SuffixArray(words, tests).find(tests))


def _find_long(raw: np.ndarray, tests: Tests, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One text's word bounds and occurrences, from shards that begin with the last words of the one before.

    Shards end between words.  A word that fills a shard and is longer than any
    word of the items is counted and stepped over.
    """
    at, total, back, again = 0, 0, 0, 0                  # next byte; words before it; repeated words' first byte, number
    spots, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while at < len(raw):
        end = min(at + shard, len(raw))
        if end < len(raw) and _OF_WORD[raw[end - 1]] and _OF_WORD[raw[end]]:
            gaps = np.flatnonzero(~_OF_WORD[raw[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                while end < len(raw) and _OF_WORD[raw[end]]:
                    ahead = np.flatnonzero(~_OF_WORD[raw[end:end + shard]])
                    end = end + int(ahead[0]) if len(ahead) else min(end + shard, len(raw))
                if end - at > tests.longest_word:
                    total, at, back, again = total + 1, end, end, 0
                    continue
        words = _split(raw[back:end], np.array([0, end - back]))
        own, where = _occurrences(words, tests)
        fresh = own + tests.lengths[where] > again       # the others were found before
        spots.append(own[fresh] + total - again)
        found.append(where[fresh])
        total += len(words.hashes) - again
        again = min(len(words.hashes), tests.window - 1)
        back = back + int(words.starts[len(words.hashes) - again]) if again else end
        at = end
    return np.array([0, total]), np.concatenate(spots), np.concatenate(found)


def _covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    change = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def _verified(words: Words, tests: Tests, spots: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences whose words are spelled as the window's (hashes chose them)."""
    ends = spots + tests.lengths[found]
    at = np.flatnonzero(_covered(len(words.hashes), spots, ends))
    ids = np.searchsorted(tests.vocabulary, words.hashes[at])
    wrong = [i for i, k in zip(at.tolist(), ids.tolist(), strict=True)
             if words.data[words.starts[i]:words.ends[i]].tobytes() != tests.spelling(k)]
    if not wrong:
        return spots, found
    before = np.cumsum(np.bincount(np.array(wrong) + 1, minlength=len(words.hashes) + 1))
    good = before[ends] == before[spots]
    return spots[good], found[good]


_READY: dict[tuple[str, int], Tests] = {}


def _ready(block: list[tuple[str, str]], window: int) -> Tests:
    """The block's arrays, kept by the Python worker for its next tasks."""
    sha = hashlib.sha256()
    for name, body in block:
        for part in (name, body):
            data = part.encode("utf-8", "surrogatepass")
            sha.update(len(data).to_bytes(8, "little") + data)
    key = (sha.hexdigest(), window)
    if key not in _READY:
        _READY.clear()
        _READY[key] = Tests(block, window)
    return _READY[key]


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of bounded text, read one partition at a time."""
    block, size = [], 0
    for name, body in benchmark.select(F.col(item).cast("string"), F.coalesce(text, F.lit(""))).toLocalIterator():
        if block and size + len(body) > limit:
            yield block
            block, size = [], 0
        block.append((name if name is not None else "null", body))
        size += len(body)
    if block:
        yield block


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """Add to every row its verbatim matches with benchmark items.

    Each task builds suffix arrays over shards of its whole texts and binary
    searches every test suffix there.  New columns (their names, made free of
    clashes, are the second result): n_words, first and length (ranges of hit
    words), longest (words of the longest verbatim match of one item) and items
    (names of the items with an occurring window).  A benchmark block is
    bounded and its arrays are kept by each Python worker; more blocks search the
    same rows one after the other, so nothing is joined.  A long text is searched
    in overlapping shards, so memory does not follow its length.

    Null texts have no words, an item without words matches nothing, items of
    the same name count once, repeated rows are searched alike, no items and no
    rows are fine.
    """
    names = {n: free_name(n, docs.columns) for n in ("n_words", "first", "length", "longest", "items")}
    long, longs, strings = T.LongType(), T.ArrayType(T.LongType()), T.ArrayType(T.StringType())
    schema = T.StructType([*docs.schema.fields, *[T.StructField(names[n], kind) for n, kind in zip(
        names, (long, longs, longs, long, strings), strict=True)]])
    width, spot = len(docs.columns), docs.columns.index(text)

    def search(block: list[tuple[str, str]], more: bool):
        def run(batches: Batches) -> Batches:
            tests = _ready(block, window)
            for b in chunks(batches, text, SHARD_BYTES):
                m = find_matches(b.column(spot), tests)
                if more:
                    _merge(b, width, m)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:width], pa.array(m.words, pa.int64()), pa.array(m.firsts, pa.list_(pa.int64())),
                     pa.array(m.lengths, pa.list_(pa.int64())), pa.array(m.longest, pa.int64()),
                     pa.array(m.items, pa.list_(pa.string()))], names=schema.names)
        return run

    out, more = docs, False
    for block in _blocks(benchmark, item, "text", block_bytes):
        if more:
            out = store(out, "decontamination-block")
        out, more = map_batches(out, search(block, more), schema), True
    if not more:
        out = map_batches(docs, search([], False), schema)
    return out, names


def _merge(b: pa.RecordBatch, width: int, m: Matches) -> None:
    """Add the matches that earlier blocks left on the rows."""
    firsts, lengths, longest, items = (b.column(width + k).to_pylist() for k in (1, 2, 3, 4))
    for d in range(b.num_rows):
        m.items[d] = sorted({*m.items[d], *items[d]})
        m.longest[d] = max(m.longest[d], longest[d])
        runs: list[list[int]] = []
        for f, n in sorted([*zip(m.firsts[d], m.lengths[d], strict=True), *zip(firsts[d], lengths[d], strict=True)]):
            if runs and f <= runs[-1][0] + runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], f + n - runs[-1][0])
            else:
                runs.append([f, n])
        m.firsts[d], m.lengths[d] = [r[0] for r in runs], [r[1] for r in runs]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of any benchmark item, columns as they are."""
    found, names = find_overlaps(docs, benchmark, text, window=window)
    return found.filter(F.size(names["items"]) == 0).select(*docs.columns)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, _ = find_overlaps(docs, table(spark, sf_dir, "benchmark"))
    hits = F.aggregate("length", F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (hits > 0).alias("contaminated"))


ORACLE = r"""
WITH lower_case AS (
  SELECT translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text, doc_id,
         row_number() OVER () AS doc_row FROM documents),
d AS (SELECT doc_row, doc_id, coalesce(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM lower_case),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_at AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k
            FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS words FROM item_at),
doc_at AS (SELECT doc_row, n, w, unnest(range(1, len(w) - n + 2)) AS k
           FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
doc_windows AS (SELECT doc_row, n, k, array_to_string(w[k:k + n - 1], ' ') AS words FROM doc_at),
hits AS (SELECT doc_row, k, n, item_id FROM doc_windows JOIN windows USING (n, words)),
hit_words AS (SELECT doc_row, count(DISTINCT place) AS n_hit FROM (SELECT doc_row, unnest(range(k, k + n)) AS place FROM hits) GROUP BY doc_row),
hit_items AS (SELECT doc_row, count(DISTINCT item_id) AS n_items,
                     string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
              FROM hits GROUP BY doc_row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_row) LEFT JOIN hit_items USING (doc_row)
"""
