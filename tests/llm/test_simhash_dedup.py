import re

import numpy as np
import pytest
import xxhash

from helpers import SF, documents, texts
from mishap.llm import simhash_dedup as D
from mishap.llm.components import connected_components


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), seed=42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h)) if h else 0


def classes(fps, bits=4):
    """Brute force: the number of each value's class."""
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    return [find(k) for k in range(len(fps))]


def test_query_equals_brute_force(spark):
    docs = documents()
    fps = [fingerprint(t) for _, t in docs]
    found = classes(fps)
    least = {}
    for (i, _), c in zip(docs, found, strict=True):
        least[c] = min(least.get(c, i), i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in D.op8_simhash_dedup(spark, SF).collect()}
    assert got == {i: (f"{f:016x}", least[c]) for (i, _), f, c in zip(docs, fps, found, strict=True)}


def near_copies(n, flips, seed):
    rng = np.random.default_rng(seed)
    base = [int(x) for x in rng.integers(0, 1 << 63, 4)]
    out = set()
    while len(out) < n:
        x = base[rng.integers(4)]
        for b in rng.integers(0, 64, rng.integers(0, flips + 1)):
            x ^= 1 << int(b)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("crowd", [4096, 40])
@pytest.mark.parametrize("flips", [3, 9])
def test_links_connect_what_brute_force_connects(spark, crowd, flips):
    fps = near_copies(400, flips, flips)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    of = {r.node: r.component for r in connected_components(D.links(frame, crowd=crowd)).collect()}
    got, want = [of.get(f, f) for f in signed], classes(fps)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_crowds_pivots_and_masks():
    fps = np.array(near_copies(300, 6, 5), np.uint64)
    a, b = D.crowd_links(fps, 4)
    assert (np.bitwise_count(a ^ b) <= 4).all() and len(a) == len(fps) - len(set(classes([int(f) for f in fps])))
    table = D.pivot_table(fps)
    i, j = np.triu_indices(len(fps), 1)
    hit = D.near(fps, table, i, j, 4)
    assert set(hit.tolist()) == set(np.flatnonzero(np.bitwise_count(fps[i] ^ fps[j]) <= 4).tolist())
    masks = D.block_masks(6, 4)
    assert len(masks) == 15 and all(any((m & (int(x) ^ int(y))) == 0 for m in masks) for x, y in zip(a, b, strict=True))
    assert D.blocks_for(1000) == 6 and D.blocks_for(10 ** 9) > 6


def test_components_of_a_chain_and_a_star(spark):
    rows = [(k, k + 1) for k in range(40)] + [(1000, k) for k in range(2000, 2300)] + [(5000, 5000), (7, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 1000 for k in [1000, *range(2000, 2300)]}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


ROWS = [(5, "a b c d e f g"), (3, "A B c d  E f g"), (9, None), (8, ""), (7, "\t \n"), (3, "A B c d  E f g"), (None, "a b c d e f g"),
        (1, "quite different words stand in this text"), (2, "two words"), (4, "word " * 60_000)]


def test_nulls_empties_ties_and_repeats(spark):
    frame = texts(spark, [(*r, 1, "x") for r in ROWS], ", fp int, component_id string")
    got = [tuple(r) for r in D.near_duplicates(frame).collect()]
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    first = {5: 3, 3: 3, None: 3, 9: 7, 8: 7, 7: 7, 1: 1, 2: 2, 4: 4}
    assert sorted(got, key=repr) == sorted(((i, signed(fingerprint(t)), first[i]) for i, t in ROWS), key=repr)


def test_one_row_of_each_group_stays(spark):
    frame = texts(spark, [(*r, 1, k) for k, r in enumerate(ROWS)], ", fp int, rank int")
    got = D.keep_first(frame)
    assert got.columns == frame.columns
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted([3, 7, 1, 2, 4, None], key=repr)
    assert D.keep_first(frame.limit(0)).count() == 0


A, B, C = "the first text has these words in it", "another one says something else entirely here", "a third is not like those"


@pytest.mark.parametrize("rows, want", [
    ([(3, B), (5, A), (5, B), (7, A)], [(3, B), (5, A)]),           # one id, two classes
    ([(5, A), (5, B)], [(5, A), (5, B)]),                           # nothing links them
    ([(5, A), (5, A), (6, A), (5, B), (5, B)], [(5, A), (5, B)]),
    ([(None, A), (None, A), (None, B), (4, C), (4, C)], [(None, A), (None, B), (4, C)]),
])
def test_rows_are_decided_not_keys(spark, rows, want):
    got = [tuple(r) for r in D.keep_first(texts(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_copies_without_a_key_that_differ_in_other_columns(spark):
    frame = texts(spark, [(None, A, k, None) for k in range(3)] + [(1, B, None, 2), (1, B, 2, None), (2, None, 1, 1)], ", row int, stays int")
    got = D.keep_first(frame)
    assert got.columns == frame.columns and sorted((r.doc_id for r in got.collect()), key=repr) == sorted([None, 1, 2], key=repr)


def test_no_key_holds_a_whole_crowd(spark):
    signed = [f - (1 << 64) if f >> 63 else f for f in near_copies(1200, 3, 3)]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    most = lambda crowd: D.candidates(frame, crowd=crowd).groupBy("mask", "key").count().agg({"count": "max"}).first()[0]
    assert most(4096) > 120 and most(40) < 120
