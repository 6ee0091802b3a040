import re

import corpus_pipeline as P
from helpers import DOCS, SF, documents, duck
from test_decontamination import words
from test_simhash_dedup import classes, fingerprint
from mishap.llm.common import store, table
from mishap.llm.packing import op3_packing
from mishap.llm.surrogates import QUERY_KEY, detect, replace

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute(docs, items):
    """Ids and texts that stand before packing, every decision made the plain way."""
    docs = [(i, t) for i, t in docs if t and re.search(r"[^\W\d_]", t)]
    first = {}
    for (i, _), c in zip(docs, classes([fingerprint(t) for _, t in docs]), strict=True):
        first[c] = min(first.get(c, i), i)
    docs = [(i, t) for i, t in docs if i in first.values()]
    windows = {tuple(w[k:k + 10]) for w in map(words, items) for k in range(max(1, len(w) - 9) if w else 0)}
    sizes = {len(w) for w in windows}
    kept = []
    for i, t in docs:
        w = words(t)
        if not any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w))):
            kept.append((i, replace(t, QUERY_KEY, {})[0] if detect(t) else t))
    return kept


def test_stages_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    for _, stage in P.STAGES[:-1]:
        docs = store(stage(spark, docs, SF), "test-stage")
        assert docs.columns == COLUMNS
    items = [t for (t,) in duck().execute("SELECT text FROM benchmark").fetchall()]
    rows = docs.collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted(brute(documents(), items))
    assert all(r.n_chars == len(r.text) for r in rows)


def test_run_gives_every_kept_document_packed(spark):
    got = P.run(spark, SF)
    whole = op3_packing(spark, SF)
    assert got.columns == whole.columns and [n for n, _ in P.STAGES] == [
        "language_id", "simhash_dedup", "decontamination", "pii", "packing"]
    rows = got.collect()
    tokens = {}
    for r in rows:
        tokens.setdefault(r.doc_id, [r.doc_tokens, 0])[1] += r.length
    assert all(a == b for a, b in tokens.values())
    assert {r.doc_id for r in rows} < {r.doc_id for r in whole.select("doc_id").collect()}


def test_stages_on_odd_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the cat", "en", "s", 7), (3, "the cat and the dog", "en", "s", 19),
            (3, "the cat and the dog", "en", "s", 19), (4, "12 34", "en", "s", 5)]
    docs = spark.createDataFrame(rows * 1 + [(k, f"the cat number {k} sat on the mat", "en", "s", 1) for k in range(10, 30)], DOCS)
    for frame, least in ((docs, 10), (docs.limit(0), 0)):
        for _, stage in P.STAGES[:-1]:
            frame = store(stage(spark, frame, SF), "test-odd")
            assert frame.columns == COLUMNS
        ids = [r.doc_id for r in frame.collect()]
        assert len(ids) >= least and not {1, 2, 4} & set(ids) and ids.count(3) <= 1
        assert P.STAGES[-1][1](spark, frame, SF).count() == len(ids)
