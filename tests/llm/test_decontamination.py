import hashlib
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from helpers import SF, documents, duck, texts
from mishap.llm.decontamination import Tests, decontaminate, find_matches, find_overlaps, op7_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    """(number of words, hit words, item names, longest verbatim match)"""
    own, hit, names, longest = words(text), set(), set(), 0
    for name, body in items:
        w = words(body)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            for j in range(len(own) - n + 1):
                if own[j:j + n] == w[i:i + n]:
                    m = n
                    while n == window and i + m < len(w) and j + m < len(own) and own[j + m] == w[i + m]:
                        m += 1
                    hit |= set(range(j, j + n))
                    names.add(str(name))
                    longest = max(longest, m)
    return len(own), hit, sorted(names), longest


def test_query_equals_brute_force(spark):
    items = duck().execute("SELECT item_id, text FROM benchmark").fetchall()
    windows = {}
    for name, body in items:
        w = words(body)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(name)
    got = {r.doc_id: r for r in op7_decontamination(spark, SF).collect()}
    for i, text in documents():
        own, hit, names = words(text), set(), set()
        for j in range(len(own)):
            for n in {len(x) for x in windows}:
                if tuple(own[j:j + n]) in windows:
                    hit |= set(range(j, j + n))
                    names |= windows[tuple(own[j:j + n])]
        sha = hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(own), len(hit), len(names), sha, bool(hit))


ITEMS = [(1, "alpha beta gamma delta"), (2, "one two three four five six seven eight nine ten eleven twelve"), (3, None), (4, ""),
         (2, "repeated item alpha"), (None, "zeta eta"), (5, "Straße Über 東京 x1"), (6, "alpha")]
ROWS = [(1, "x Alpha, beta; GAMMA delta y"), (2, "one two three four five six seven eight nine ten eleven twelve thirteen"),
        (3, None), (4, ""), (5, "one two three four five six seven eight nine"), (1, "x Alpha, beta; GAMMA delta y"),
        (None, "straße über 東京 X1 alpha-alpha"), (6, "alpha beta"), (7, "gamma delta"), (8, "... !!"),
        (9, "zeta" + " filler" * 60_000 + " zeta eta"), (10, "two three four five six seven eight nine ten eleven one two")]


@pytest.mark.parametrize("block", [1 << 20, 30])
def test_cases_with_one_and_with_many_blocks(spark, block):
    frame = texts(spark, [(*r, 5, "own") for r in ROWS], ", n_words int, items string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string").coalesce(1)
    found, names = find_overlaps(frame, bench, block_bytes=block)
    assert names["n_words"] == "n_words_" and found.columns[:4] == frame.columns
    got = found.collect()
    assert len(got) == len(ROWS)
    items = [("null" if n is None else n, t) for n, t in ITEMS]
    for r in got:
        n, hit, who, longest = brute(r.text, items)
        spans = {k for a, m in zip(r["first"], r["length"], strict=True) for k in range(a, a + m)}
        assert (r["n_words_"], spans, r["items_"], r["longest"]) == (n, hit, who, longest), r.doc_id


def test_long_texts_in_shards_equal_whole_ones():
    rng = np.random.default_rng(4)
    names = list("abc") + ["D" * 9, "é", "x" * 40]
    draw = lambda n: " ".join(rng.choice(names, n, p=[.4, .3, .1, .1, .05, .05]))
    for n, window in ((0, 10), (1, 3), (6, 4), (12, 10)):
        items = [(str(k), draw(int(rng.integers(0, 15)))) for k in range(n)] + [("again", "a b a")]
        tests = Tests(items, window)
        for _ in range(12):
            text = draw(int(rng.integers(1, 120))) + rng.choice(["", ", ", " " + "y" * 300 + " a b a", "z" * 90])
            size, hit, who, longest = brute(text, items, window)
            for shard in (1, 5, 33, 100, 1 << 20):
                m = find_matches(pa.array([text]), tests, shard)
                spans = [k for a, n in zip(m.firsts[0], m.lengths[0], strict=True) for k in range(a, a + n)]
                assert (int(m.words[0]), spans, m.items[0], int(m.longest[0])) == (size, sorted(hit), who, longest), (text, shard)


def test_memory_of_a_large_benchmark_and_of_a_long_text():
    rng = np.random.default_rng(8)
    words = np.array(["".join(x) for x in rng.choice(list("abcdefgh"), (30_000, 5))])
    items = [(str(k), " ".join(rng.choice(words, 1000))) for k in range(1400)]
    tracemalloc.start()
    tests = Tests(items, 10)
    built = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    text = " ".join(rng.choice(words, 2_000_000)) + " " + items[7][1]
    column = pa.array([text])
    before = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    m = find_matches(column, tests)
    most = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert sum(len(t) for _, t in items) > 8_000_000 and built < 450_000_000 and most < 250_000_000
    assert m.items == [["7"]] and m.lengths == [[1000]] and m.firsts == [[2_000_000]] and m.longest.tolist() == [1000]


def test_texts_never_run_together(spark):
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    rows = [(k, t) for k, t in enumerate(["x a b", "c d y", "a b c", "d", "a b c d"])]
    got = decontaminate(texts(spark, rows).coalesce(1), bench)
    assert sorted(r.doc_id for r in got.collect()) == [0, 1, 2, 3]


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    frame = texts(spark, [(1, "a b"), (2, "c")])
    assert decontaminate(frame.limit(0), bench).count() == 0
    assert decontaminate(frame, bench.limit(0)).count() == 2
    assert [r.doc_id for r in decontaminate(frame, bench).collect()] == [2]
