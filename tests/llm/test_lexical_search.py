import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import SF, duck, texts
from mishap.llm import lexical_search
from mishap.llm.lexical_search import ORACLE, op12_lexical_search, search, term_counts


def terms(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def brute(docs, items, top=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [c.total() for _, c in counted]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, text in items:
        rows = []
        for (i, c), size in zip(counted, sizes, strict=True):
            score = 0
            for w in terms(text):
                if c[w]:
                    m = 25 + 75 * size * n // length
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10 ** 9 * c[w] // (1000 * c[w] + 8 * m))
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, i, -score) for k, (score, _, _, i) in enumerate(sorted(rows)[:top])]
    return out


def result(spark, docs, items, **more):
    frame = spark.createDataFrame(items, "item_id string, text string, doc_id int, rank string, size int, pos int, before int")
    return [(r.item_id, r.rank, r.doc_id, r.score) for r in search(texts(spark, docs), frame, **more).collect()]


def widened(items):
    return [(i, t, 1, "x", 2, 3, 4) for i, t in items]


@pytest.mark.parametrize("text", ["", "a", "The the THE 12a", "é漢字🙂x-y", "a_b\x7fc\x00d", "ÀÉ " * 5, " " * 40, "İß"])
def test_terms(text):
    assert term_counts(text.encode()) == Counter(w.encode() for w in terms(text))


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(lexical_search, "PIECE_BYTES", 7)
    text = "one two, three " * 50 + "x" * 300 + " end"
    assert term_counts(text.encode()) == Counter(w.encode() for w in terms(text))


@pytest.mark.parametrize("owners", [1, 3, 9])
def test_brute_force(spark, monkeypatch, owners):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 13)
    monkeypatch.setattr(lexical_search, "BUNDLE_ITEMS", 3)
    monkeypatch.setattr(lexical_search, "GROUP_BYTES", 120)
    rng = random.Random(owners)
    common, rare = ["the", "of", "and"], [f"w{k}" for k in range(60)]
    docs = [(i, " ".join(rng.choices(common, k=rng.randint(0, 9)) + rng.choices(rare, k=rng.randint(0, 6)))) for i in range(150)]
    docs += [(7, "the of w1"), (None, "w1 w2"), (None, None), (200, None), (201, ""), (202, "..."), (203, "w3 " * 9000)]
    docs += [(300 + k, "The same w5 w6") for k in range(20)]
    items = [(f"i{k}", " ".join(rng.choices(common + rare, k=rng.randint(1, 12)))) for k in range(20)]
    items += [("none", None), ("empty", ""), ("unknown", "zzz"), ("twice", "w5 w5 The"), (None, "w1")]
    want = brute(docs, items)
    got = result(spark, docs, widened(items), owners=owners)
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_repeated_items(spark):
    got = result(spark, [(1, "a b"), (2, "a"), (3, "c")], widened([("x", "a"), ("x", "a"), ("x", "c")]))
    assert sorted(got) == sorted(brute([(1, "a b"), (2, "a"), (3, "c")], [("x", "a"), ("x", "a"), ("x", "c")]))


def test_empty_tables(spark):
    assert result(spark, [], widened([("x", "a")])) == []
    assert result(spark, [(1, "a")], []) == []
    assert result(spark, [(1, None), (2, "")], widened([("x", "a")])) == []


def test_query_equals_sql(spark):
    got = sorted((r.item_id, r.rank, r.doc_id, r.score) for r in op12_lexical_search(spark, SF).collect())
    assert got == sorted(duck().execute(ORACLE).fetchall()) and len(got) > 300


def test_no_row_grows_with_the_block(spark, monkeypatch):
    """Stored rows are a document's, and tasks get the texts in small batches: memory doesn't follow the size of a block."""
    largest, batches, limits = {}, [], set()
    store, map_batches = lexical_search.store, lexical_search.map_batches

    def watched(df, name):
        blobs = [f.name for f in df.schema.fields if f.dataType.typeName() == "binary"]
        limits.add(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None))
        stored = store(df, name)
        if blobs:
            most = stored.agg(F.max(sum(F.octet_length(c) for c in blobs))).first()[0] or 0
            largest[name] = max(largest.get(name, 0), most)
        return stored

    def counted(df, fn, schema):
        def sizes(found):
            for b in found:
                yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["bytes"])
        batches.append(map_batches(df, sizes, "bytes long").agg(F.max("bytes")).first()[0])
        return map_batches(df, fn, schema)

    monkeypatch.setattr(lexical_search, "store", watched)
    monkeypatch.setattr(lexical_search, "map_batches", counted)
    monkeypatch.setattr(lexical_search, "BATCH_BYTES", 20_000)
    docs = [(i, f"the of w{i % 50} " + "x" * 200) for i in range(1000)]
    items = [(f"i{k}", f"the of w{k % 50}") for k in range(120)]
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    got = result(spark, docs, widened(items))
    assert sorted(got) == sorted(brute(docs, items))
    assert set(largest) == {"lexical-index", "lexical-bundles"}
    assert max(largest.values()) <= 10 * len(items)          # what one document holds: an item and its score take ten bytes
    assert max(b for b in batches if b) <= 40_000
    assert "20000" in limits and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before


def test_items_beyond_a_bundle(spark, monkeypatch):
    """Every bundle meets its own postings only: documents and items of several bundles, some without common terms."""
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 40)
    monkeypatch.setattr(lexical_search, "BUNDLE_ITEMS", 2)
    docs = [(i, f"w{i % 7} w{i % 3} " * (i % 4)) for i in range(120)] + [(None, "w1"), (None, "w1 w2")]
    items = [(f"i{k}", f"w{k} v{k} w{k % 2}") for k in range(9)] + [("none", None), ("other", "zzz")]
    assert sorted(map(repr, result(spark, docs, widened(items)))) == sorted(map(repr, brute(docs, items)))
