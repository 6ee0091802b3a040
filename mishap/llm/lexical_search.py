"""Operator 12: ranked lexical search, item bundles passing from one owner of terms to the next."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap.llm.common import Batches, batch_bytes, chunks, free_name, map_batches, store, table, text_buffers, with_positions

TOP = 10
OWNERS = 4
BLOCK_DOCS, BLOCK_BYTES = 4096, 8 * 1024 * 1024
"""A block is so many documents and bytes of text at most (or one document)."""
PIECE_BYTES = 1024 * 1024
BATCH_BYTES = 4 * 1024 * 1024
"""Tasks get the texts and postings in Arrow batches of about so many bytes."""
GROUP_BYTES = 4 * 1024 * 1024
"""Items are searched in groups of so many bytes of text; more items take more passes."""
BUNDLE_ITEMS = 256
MOST = 999_999
"""No occurrence's factor is larger: (10^9 tf) div (1000 tf + 8 m) with m of at least 25."""

# Bytes of terms: digits, letters (A-Z lower-cased) and all of other characters; any other is a blank.
_FOLD = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, in lists of about ``PIECE_BYTES`` (cut between terms)."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        to = folded.find(b" ", at + PIECE_BYTES)
        to = len(folded) if to < 0 else to
        yield folded[at:to].split()
        at = to


def term_counts(text: bytes) -> Counter:
    found: Counter = Counter()
    for piece in words(text):
        found.update(piece)
    return found


def flat(column: pa.Array | pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column's rows, end to end, and how many of them each row has."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw, at = text_buffers(column.cast(pa.binary()))
    numbers = raw.view(kind)
    return numbers, np.diff(at) // numbers.itemsize


def packed(numbers: np.ndarray, n: Sequence[int] | np.ndarray, kind: str) -> pa.Array:
    """A binary column whose rows hold the next ``n`` of the numbers each."""
    raw = np.ascontiguousarray(numbers, kind)
    at = np.concatenate([[0], np.cumsum(n)]) * raw.itemsize
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)])


def index(docs: DataFrame, vocabulary: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: its ``block`` and ``slot`` there, ``doc`` (its key), ``size`` (its terms), and which terms of
    the vocabulary it holds how often."""
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("slot", T.IntegerType()),
                           T.StructField("doc", docs.schema[key].dataType), T.StructField("size", T.LongType()),
                           T.StructField("terms", T.BinaryType()), T.StructField("counts", T.BinaryType())])

    most_docs, most_bytes = BLOCK_DOCS, BLOCK_BYTES

    def run(batches: Batches) -> Batches:
        block, slot, held = TaskContext.get().partitionId() << 33, 0, 0
        for b in chunks(batches, text, PIECE_BYTES):
            places, sizes, found = [], [], []
            for whole in b.column(1).cast(pa.binary()).to_pylist():
                whole = whole or b""
                if slot and (slot >= most_docs or held + len(whole) > most_bytes):
                    block, slot, held = block + 1, 0, 0
                counts = term_counts(whole)
                places.append((block, slot))
                sizes.append(counts.total())
                found.append([(vocabulary[w], counts[w]) for w in counts.keys() & vocabulary.keys()])
                slot, held = slot + 1, held + len(whole)
            n = [len(d) for d in found]
            both = np.array([pair for d in found for pair in d], np.int64).reshape(-1, 2)
            both = both[np.lexsort((both[:, 0], np.repeat(np.arange(len(n)), n)))]
            blocks, slots = zip(*places, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(slots, pa.int32()), b.column(0), pa.array(sizes, pa.int64()),
                 packed(both[:, 0], n, "<i4"), packed(both[:, 1], n, "<i4")], names=schema.names)

    return map_batches(docs.select(key, text), run, schema)


def frequencies(blocks: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary: a task sends one row a term."""
    def run(batches: Batches) -> Batches:
        total = np.zeros(terms, np.int64)
        for b in batches:
            total += np.bincount(flat(b.column(0), "<i4")[0], minlength=terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "df"])

    rows = map_batches(blocks.select("terms"), run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    found = np.zeros(terms, np.int64)
    for r in rows.collect():
        found[r["term"]] = r["df"]
    return found


@dataclass
class Plan:
    """What the stages know of a group of items: who owns which term, and what an occurrence adds to which item."""
    owner: np.ndarray                                # of each term; -1: in no document
    adds: list[dict[int, tuple[np.ndarray, np.ndarray]]]     # by bundle: term -> (items, weight times repeats)
    rest: list[list[np.ndarray]]                     # by bundle and owner: the most that later owners can add to an item
    docs: int
    length: int

    @classmethod
    def of(cls, items: Sequence[Counter], vocabulary: dict[bytes, int], df: np.ndarray, docs: int, length: int,
           owners: int = OWNERS) -> Plan:
        """Owners get about equal numbers of postings, the first the rarest terms, so that bundles fill up late."""
        weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        order = np.lexsort([np.arange(len(df)), df])
        order = order[df[order] > 0]
        before = np.cumsum(df[order]) - df[order]
        owner = np.full(len(df), -1)
        owner[order] = before * owners // max(int(df.sum()), 1)
        adds, rest = [], []
        for at in range(0, len(items), BUNDLE_ITEMS):
            own: dict[int, list[tuple[int, int]]] = {}
            later = [np.zeros(min(BUNDLE_ITEMS, len(items) - at), np.int64) for _ in range(owners)]
            for k, counts in enumerate(items[at:at + BUNDLE_ITEMS]):
                for word, times in counts.items():
                    term = vocabulary[word]
                    if owner[term] >= 0:
                        own.setdefault(term, []).append((k, int(weight[term]) * times))
                        for stage in range(owner[term]):
                            later[stage][k] += int(weight[term]) * times * MOST
            adds.append({t: tuple(np.array(x, np.int64) for x in zip(*pairs, strict=True)) for t, pairs in own.items()})
            rest.append(later)
        return cls(owner, adds, rest, docs, length)


def _placed(kind: T.DataType, *blobs: str) -> T.StructType:
    """Rows of a document (its key of type ``kind``) in a bundle, with binary columns."""
    return T.StructType([T.StructField("block", T.LongType()), T.StructField("bundle", T.IntegerType()),
                         T.StructField("slot", T.IntegerType()), T.StructField("doc", kind),
                         *[T.StructField(n, T.BinaryType()) for n in blobs]])


def owned(blocks: DataFrame, plan: Plan, owner: int) -> DataFrame:
    """One row a bundle and document: the factors of the owner's postings that the bundle's items ask for."""
    asked = [np.array([t for t in adds if plan.owner[t] == owner], np.int64) for adds in plan.adds]
    vocabulary, docs, length = len(plan.owner), plan.docs, plan.length
    schema = _placed(blocks.schema["doc"].dataType, "terms", "factors")

    def run(batches: Batches) -> Batches:
        wanted = np.zeros(vocabulary, bool)
        for b in chunks(batches, "terms", PIECE_BYTES):
            terms, n = flat(b.column("terms"), "<i4")
            counts, _ = flat(b.column("counts"), "<i4")
            rows = np.repeat(np.arange(len(n)), n)
            norm = np.array([100 - 75 + 75 * s * docs // length for s in b.column("size").to_pylist()], np.int64)
            for bundle, own in enumerate(asked):
                wanted[own] = True
                keep = np.flatnonzero(wanted[terms])
                wanted[own] = False
                if not len(keep):
                    continue
                tf = counts[keep].astype(np.int64)
                factors = 1_000_000_000 * tf // (1000 * tf + 8 * norm[rows[keep]])
                size = np.bincount(rows[keep], minlength=len(n))
                here = np.flatnonzero(size)
                yield pa.RecordBatch.from_arrays(
                    [b.column("block").take(pa.array(here)), pa.array(np.full(len(here), bundle, np.int32)),
                     b.column("slot").take(pa.array(here)), b.column("doc").take(pa.array(here)),
                     packed(terms[keep], size[here], "<i4"), packed(factors, size[here], "<i4")], names=schema.names)

    return map_batches(blocks, run, schema)


def pass_on(bundles: DataFrame, blocks: DataFrame, plan: Plan, owner: int, top: int = TOP) -> DataFrame:
    """Bundles meet the owner's postings of their block, add what its terms are worth, and go on.

    A bundle is the sparse scores of up to ``BUNDLE_ITEMS`` items for the
    documents of one block, a row for each document with a score: no row
    grows with the block.  Before it goes on, a document leaves an item's
    scores if even all that later owners can add would not lift it to the
    block's ``top``-th score so far: exact, since at least ``top`` documents of
    the block end above it.  The last owner gives each item's ``top`` documents
    of the block instead.
    """
    last, each = owner + 1 == len(plan.rest[0]), BUNDLE_ITEMS
    kind = blocks.schema["doc"].dataType
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc", kind),
                           T.StructField("score", T.LongType())]) if last else bundles.schema

    def stage(group: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        block, bundle = (k.as_py() for k in group)
        adds, later = plan.adds[bundle], plan.rest[bundle][owner]
        both = pa.concat_tables([t.select(["slot", "doc"]) for t in (left, right) if t.num_rows]).combine_chunks()
        slots, first, at = np.unique(both["slot"].to_numpy(), return_index=True, return_inverse=True)
        docs = both["doc"].combine_chunks().take(pa.array(first))
        scores = np.zeros((len(later), len(slots)), np.int64)
        if left.num_rows:
            items, n = flat(left["items"], "<u2")
            scores[items, np.repeat(at[:left.num_rows], n)] = flat(left["scores"], "<i8")[0]
        if right.num_rows:
            terms, n = flat(right["terms"], "<i4")
            order = np.argsort(terms, kind="stable")
            where = np.repeat(at[left.num_rows:], n)[order]
            factors = flat(right["factors"], "<i4")[0][order].astype(np.int64)
            found, starts = np.unique(terms[order], return_index=True)
            for term, start, end in zip(found.tolist(), starts.tolist(), [*starts[1:].tolist(), len(terms)], strict=True):
                items, worth = adds[term]
                scores[np.ix_(items, where[start:end])] += worth[:, None] * factors[start:end]
        if len(slots) > top:
            least = np.partition(scores, len(slots) - top, axis=1)[:, len(slots) - top]
            scores[scores + later[:, None] < least[:, None]] = 0
        if last:
            items, found = _best(scores, docs.to_pylist(), top)
            return pa.Table.from_arrays([pa.array(items + bundle * each), docs.take(pa.array(found)), pa.array(scores[items, found])],
                                        names=schema.names)
        found, items = np.nonzero(scores.T)
        n = np.bincount(found, minlength=len(slots))
        here = np.flatnonzero(n)
        return pa.Table.from_arrays(
            [pa.array(np.full(len(here), block, np.int64)), pa.array(np.full(len(here), bundle, np.int32)),
             pa.array(slots[here].astype(np.int32)), docs.take(pa.array(here)), packed(items, n[here], "<u2"),
             packed(scores[items, found], n[here], "<i8")], names=schema.names)

    met = ("block", "bundle")
    return bundles.groupBy(*met).cogroup(owned(blocks, plan, owner).groupBy(*met)).applyInArrow(stage, schema)


def _best(scores: np.ndarray, docs: list, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(items, documents) of the ``top`` highest scores above 0 of each item, ties to the smaller key, null keys last."""
    place = np.zeros(len(docs), np.int64)
    place[sorted(range(len(docs)), key=lambda k: (docs[k] is None, docs[k]))] = np.arange(len(docs))
    items, found = np.nonzero(scores)
    order = np.lexsort((place[found], -scores[items, found], items))
    items, found = items[order], found[order]
    keep = np.arange(len(items)) - np.searchsorted(items, items) < top
    return items[keep], found[keep]


def search(docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, key: str = "doc_id",
           item: str = "item_id", text: str = "text") -> DataFrame:
    """Each item's ``top`` best documents: item, ``rank`` (from 1), key, ``score`` (above 0).

    Terms are maximal runs of digits, letters and other characters' bytes, A-Z
    lower-cased.  Documents are cut into blocks and their postings stored, a
    row a document; the terms are dealt to owners, and bundles (items' scores
    for a block) pass from owner to owner, each step a cogroup by block and
    bundle, stored in the shared folder.  A block never holds more than its
    share of documents, however frequent a term is.

    Each row of either table counts by itself, repeated keys too (an item id
    that repeats gives that many results).  Null texts have no terms: such
    documents are not counted, such items find nothing, nor do items whose
    terms no document has.  Ties go to the smaller key, null keys last; empty
    tables give no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    size, pos, before = (free_name(n, [item, text]) for n in ("size", "pos", "before"))
    sized = store(items.select(item, text).withColumn(size, F.coalesce(F.octet_length(text), F.lit(0)).cast("long")), "lexical-sizes")
    placed, n_items, total = with_positions(sized, [item, text], size, "lexical-items", pos, before)
    results = []
    for group in range(total // GROUP_BYTES + 1 if n_items else 0):
        mine = (F.col(before) >= group * GROUP_BYTES) & (F.col(before) < (group + 1) * GROUP_BYTES)
        rows = [(r[0], term_counts(r[1].encode())) for r in
                placed.filter(mine & (F.col(size) > 0)).select(pos, text).collect()]      # bounded by the group's bytes
        vocabulary = {w: k for k, w in enumerate(sorted({w for _, counts in rows for w in counts}))}
        if not vocabulary:
            continue
        with batch_bytes(spark, BATCH_BYTES):
            blocks = store(index(docs, vocabulary, key, text), "lexical-index")
            n_docs, length = blocks.agg(F.count_if(F.col("size") > 0), F.sum("size")).first()
            if not length:
                continue
            plan = Plan.of([counts for _, counts in rows], vocabulary, frequencies(blocks, len(vocabulary)), n_docs, length, owners)
            bundles = spark.createDataFrame([], _placed(docs.schema[key].dataType, "items", "scores"))
            for owner in range(owners):
                bundles = store(pass_on(bundles, blocks, plan, owner, top), "lexical-bundles")
        numbers = F.array(*[F.lit(n).cast("long") for n, _ in rows])
        results.append(bundles.withColumn("item", numbers[F.col("item").cast("int")]))
    if not results:
        return spark.createDataFrame([], T.StructType([
            items.schema[item], T.StructField("rank", T.IntegerType()), docs.schema[key], T.StructField("score", T.LongType())]))
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = placed.select(F.col(pos).alias("item"), F.col(item).alias("name"))
    return names.join(ranked, "item").select(F.col("name").alias(item), "rank", F.col("doc").alias(key), "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS doc, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
totals AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS length FROM docs WHERE len(terms) > 0),
postings AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(t.docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
            FROM postings, totals t GROUP BY term),
items AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS terms FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT item, term, count(*) AS times FROM (SELECT item, unnest(terms) AS term FROM items) GROUP BY ALL),
norms AS (SELECT doc, 100 - 75 + ((75 * len(terms) * t.docs) // t.length) AS m FROM docs, totals t),
scores AS (SELECT item, doc, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN norms USING (doc) GROUP BY item, doc),
ranked AS (SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place
           FROM scores JOIN docs USING (doc) WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked JOIN items USING (item) WHERE place <= 10
"""
