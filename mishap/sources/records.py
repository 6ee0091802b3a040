"""CSV records with quoted line breaks, read in parallel.

A splittable read cuts files at line breaks, and a line alone doesn't tell
whether it starts inside a quoted field.  But a split is a function of that:
where its last line ends (outside or inside a quoted field) if its first one
starts outside, and if it starts inside.  These functions (two booleans a
split) compose, so a prefix over the splits of a file gives every split its
start.  Lines are then joined to records inside their splits; only records
that cross a split (at most one at either end of it) are shuffled.

Inside a split the state is the parity of the quotes so far wherever quotes
stand as quoting wants them (a batch is checked at once); lines with stray
quotes are looked at one by one.

Everything is one lazy plan: the splits' functions are computed in the same
action as the records, so both see the same splits.  The table of splits is
broadcast; it has a row for each split that the driver schedules anyway.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Batches = Iterator[pa.RecordBatch]

_CLOSED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"[^,]*+'
_OPEN = '(^|,)"'


def stays_open(line: Column) -> Column:
    """Whether a line that starts outside quotes ends inside a quoted field.

    Closed quoted fields are taken out (text behind a closing quote belongs to
    the field, as Spark's parser has it); a field that still starts with a
    quote is open.  Quotes inside unquoted fields open nothing.
    """
    return F.contains(line, F.lit('"')) & F.regexp_replace(line, _CLOSED, "$1").rlike(_OPEN)


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files in their order: file, split (its first byte) and value."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")


def has_open_lines(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether any quoted field holds a line break (a job; it stops at the first)."""
    return not spark.read.option("lineSep", "\n").text(path).where(stays_open(F.col("value"))).select(F.lit(1)).isEmpty()


_CLOSED_RE, _OPEN_RE = re.compile(_CLOSED.encode()), re.compile(_OPEN.encode())


def _end(line: bytes, inside: bool) -> bool:
    """Whether one line ends inside a quoted field: ``stays_open``, from either start."""
    return bool(_OPEN_RE.search(_CLOSED_RE.sub(rb"\1", b'"' + line if inside else line)))


class Lines:
    """Lines of one split in a batch: their bytes end to end, and what their quotes say."""

    def __init__(self, column: pa.Array):
        n = len(column)
        _, where, data = column.cast(pa.string()).buffers()
        offsets = np.frombuffer(where, np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data, self.offsets, self.n = raw[offsets[0]:offsets[-1]], offsets - offsets[0], n
        quotes = np.flatnonzero(self.data == 34)
        line = np.searchsorted(self.offsets, quotes, "right") - 1
        count = np.bincount(line, minlength=n)
        self.odd = count % 2 == 1
        second = (np.arange(len(quotes)) - (np.cumsum(count) - count)[line]) % 2 == 1
        padded = np.concatenate([self.data, np.zeros(2, np.uint8)])
        ends = self.offsets[1:][line]
        follows, precedes = padded[quotes + 1], self.data[quotes - 1] if len(quotes) else quotes
        opens = (quotes == self.offsets[line]) | (precedes == 44) | (precedes == 34)
        closes = (quotes + 1 == ends) | (follows == 44) | (follows == 34) | ((follows == 13) & (quotes + 2 == ends))
        self.irregular = [np.bincount(line[~np.where(second == inside, opens, closes)], minlength=n) > 0 for inside in (False, True)]

    def states(self, inside: bool) -> tuple[np.ndarray, bool]:
        """Of every line, whether it starts inside a quoted field, and whether the last one ends so."""
        turned = np.cumsum(self.odd)
        before = (turned - self.odd) % 2 == 1
        before ^= inside
        wrong = [np.flatnonzero(np.where(before ^ flip, self.irregular[1], self.irregular[0])) for flip in (False, True)]
        flips, flip, at = [], False, 0
        while True:
            k = int(np.searchsorted(wrong[flip], at))
            if k == len(wrong[flip]):
                break
            at = int(wrong[flip][k])
            start = bool(before[at]) ^ flip
            if _end(self.data[self.offsets[at]:self.offsets[at + 1]].tobytes(), start) != (start ^ bool(self.odd[at])):
                flips.append(at + 1)
                flip = not flip
            at += 1
        if flips:
            change = np.zeros(self.n + 1, np.int64)
            change[flips] = 1
            before = before ^ (np.cumsum(change)[:-1] % 2 == 1)
        return before, bool(inside ^ bool(turned[-1] % 2) ^ flip)

    def joined(self, before: np.ndarray) -> pa.Array:
        """Records: lines that start inside a quoted field are put behind the one before, with the line break."""
        inner = np.flatnonzero(before[1:]) + 1
        data = np.insert(self.data, self.offsets[inner], np.uint8(10)) if len(inner) else self.data
        starts = np.flatnonzero(np.concatenate([[True], ~before[1:]]))
        added = np.concatenate([[0], np.cumsum(before[1:])])
        offsets = np.append((self.offsets[:-1] + added)[starts], len(data)).astype(np.int32)
        return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple[str, int], Lines]]:
    """The lines of each split in a batch, in order, with their first row and their split."""
    if not batch.num_rows:
        return
    file = batch.column(0).dictionary_encode().indices.to_numpy()
    split = batch.column(1).to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (split[1:] != split[:-1])) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for i, k in zip(edges[:-1], edges[1:], strict=True):
        yield i, (batch.column(0)[i].as_py(), batch.column(1)[i].as_py()), Lines(batch.column(2).slice(i, k - i))


def _composed(batches: Batches) -> Batches:
    """One row a split: where it ends if it starts outside, and if it starts inside."""
    key, ends = None, (False, True)

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([ends[0]]), pa.array([ends[1]])],
                                          names=["file", "split", "from_out", "from_in"])

    for b in batches:
        for _, own, lines in _runs(b):
            if own != key:
                if key is not None:
                    yield row()
                key, ends = own, (False, True)
            out = lines.states(ends[0])[1]
            ends = out, out if ends[0] == ends[1] else lines.states(ends[1])[1]
    if key is not None:
        yield row()


def split_starts(lines: DataFrame) -> DataFrame:
    """(file, split, inside, open): whether the split starts, and ends, inside a quoted field; files start outside."""
    splits = lines.mapInArrow(_composed, "file string, split long, from_out boolean, from_in boolean")
    fixed = F.col("from_out") == F.col("from_in")
    turned = (F.col("from_out") & ~F.col("from_in")).cast("int")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    since = Window.partitionBy("file", "phase").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    phased = splits.select(
        "file", "split", "from_out", "from_in", turned.alias("turned"), fixed.alias("fixed"),
        F.coalesce(F.sum(fixed.cast("int")).over(before), F.lit(0)).alias("phase"),
        F.coalesce(F.last(F.when(fixed, F.col("from_out")), ignorenulls=True).over(before), F.lit(False)).alias("base"))
    turns = F.coalesce(F.sum("turned").over(since), F.lit(0)) % 2 == 1
    inside = F.col("base") != turns
    return phased.select("file", "split", inside.alias("inside"), F.when(inside, F.col("from_in")).otherwise(F.col("from_out")).alias("open"))


def _joined(batches: Batches) -> Batches:
    """Records of the lines: whole ones (place 0), and what a split has of others: a tail (1) or a head (2)."""
    names = ["file", "split", "place", "header", "text"]
    key, inside, held, place, header = None, False, [], 1, False

    def rows(places: list[int], headers: list[bool], text: pa.Array) -> pa.RecordBatch:
        n = len(text)
        return pa.RecordBatch.from_arrays([pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()),
                                           pa.array(places, pa.int32()), pa.array(headers, pa.bool_()), text], names=names)

    def one(end: int) -> pa.RecordBatch:
        return rows([end], [header], pa.array(["\n".join(held)]))

    for b in batches:
        for at, own, lines in _runs(b):
            new = own != key
            if new:
                if held:
                    yield one(place)
                key, inside, held, place, header = own, b.column(3)[at].as_py(), [], 1, False
            before, inside = lines.states(inside)
            found = lines.joined(before)
            first, last = 0, len(found)
            if before[0]:                            # goes on with the open record
                held.append(found[0].as_py())
                first = 1
                if last == 1 and inside:
                    continue
                yield one(1 if place == 1 else 0)
                held = []
            tops = new and own[1] == 0 and not before[0]
            if inside:                               # the last record stays open (it is not the one that went on)
                last -= 1
            if last > first:
                headers = [False] * (last - first)
                headers[0] = tops
                yield rows([0] * (last - first), headers, found.slice(first, last - first))
            if inside:
                held, place, header = [found[last].as_py()], 2, tops and last == 0
    if held:
        yield one(place)


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every record of the files as one ``text`` (line breaks inside quotes kept, the closing one not),
    with ``file`` and ``header`` (the file's first record)."""
    starts = split_starts(text_lines(spark, path))

    def found(splits: DataFrame) -> DataFrame:
        placed = text_lines(spark, path).join(F.broadcast(splits), ["file", "split"]).select("file", "split", "value", "inside")
        return placed.mapInArrow(_joined, "file string, split long, place int, header boolean, text string")

    whole = found(starts).where("place = 0").select("file", "header", "text")
    pieces = found(starts.where("inside or open")).where("place > 0")
    order = Window.partitionBy("file").orderBy("split", "place")
    pieces = pieces.withColumn("record", F.sum((F.col("place") == 2).cast("int")).over(order))
    crossing = pieces.groupBy("file", "record").agg(
        F.max("header").alias("header"), F.array_sort(F.collect_list(F.struct("split", "place", "text"))).alias("parts")
    ).select("file", "header", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    return whole.unionByName(crossing).withColumn("text", F.regexp_replace("text", "\r$", ""))
