import numpy as np
import pytest

from helpers import duck
from mishap.llm.hilbert_ann import hilbert_keys, nearest, op5_hilbert_ann

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=10):
    good = [(i, np.array(v, np.float64)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = []
    for q, x in good:
        if q % 100 == 0:
            found = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in good if i != q)[:k]
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(found)]
    return out


def close(got, want):
    got, want = sorted(tuple(r) for r in got), sorted(want)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 3), (6, 2)])
def test_hilbert_curve_steps_to_neighbours(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    order = cells[np.argsort(hilbert_keys(cells, bits))]
    assert len(set(hilbert_keys(cells, bits))) == len(cells)
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_recall_and_scores(spark):
    rows = duck("/root/testdata/sf0.1").execute("SELECT vec_id, embedding FROM embeddings ORDER BY 1").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    got = {}
    for r in op5_hilbert_ann(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, []).append(r)
    hits = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        best = set(ids[np.lexsort([ids, d])][1:11])
        found = sorted(got[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        assert all(abs(r.score - d[ids == r.vec_id][0]) < 1e-12 for r in found)
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        hits += len(best & {r.vec_id for r in found})
    assert hits / 10 / len(got) >= 0.9


def test_exact_where_the_window_holds_all(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(30)] + [(300, rows[5][1])]            # copies and ties
    nan, inf = float("nan"), float("inf")
    odd = [(400, None), (500, [0.0] * 8), (600, [nan] * 8), (700, [None] * 8), (800, [inf] * 8), (None, rows[1][1]), (900, [])]
    frame = spark.createDataFrame([(*r, 1, 2.0) for r in rows + odd], SCHEMA + ", rank int, score double")
    close(nearest(frame, "vec_id % 100 = 0").collect(), brute(rows + odd))


def test_few_none_and_empty(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (100, [1.0, 0.5]), (5, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, SCHEMA)
    close(nearest(frame, "vec_id % 100 = 0").collect(), brute(rows[:4]))
    assert nearest(frame.limit(0), "vec_id % 100 = 0").count() == 0
    assert nearest(frame.filter("vec_id = 0"), "vec_id % 100 = 0").count() == 0


def test_many_equal_distances_go_to_the_smallest_ids(spark):
    rng = np.random.default_rng(3)
    unit = np.eye(40, dtype=np.float32)
    rows = [(0, [1.0] * 40)] + [(int(i), unit[n].tolist()) for n, i in enumerate(rng.permutation(np.arange(1, 41)))]
    rows += [(100, (unit[3] * 3).tolist())]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = nearest(frame, "vec_id % 100 = 0").collect()
    close(got, brute(rows))
    assert sorted(r.vec_id for r in got if r.query_id == 0) == list(range(1, 11))


def test_every_length_is_searched_among_itself(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(4).astype(np.float32).tolist()) for i in range(0, 60)]
    other = [(i, rng.standard_normal(3).astype(np.float32).tolist()) for i in range(100, 130)] + [(200, [1.0])]
    frame = spark.createDataFrame(rows + other, SCHEMA)
    close(nearest(frame, "vec_id % 100 = 0").collect(), brute(rows) + brute(other[:-1]))
    assert nearest(frame.filter("vec_id % 100 <> 0"), "vec_id % 100 = 0").count() == 0
