import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from helpers import duck, texts
from mishap.llm.quality import Discriminant, STATISTICS, describe, fit, long_statistics, op9_quality, score_quality, statistics

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    truth = dict(duck(SF).execute("SELECT doc_id, quality FROM labels").fetchall())
    rows = op9_quality(spark, SF).collect()
    assert len(rows) == duck(SF).execute("SELECT count(*) FROM documents").fetchall()[0][0]
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    good = [r for r in held if truth[r.doc_id] == 1]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert sum(r.predicted for r in good) / len(good) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_statistics_do_not_depend_on_the_batch():
    rows = ["Plain words. And more!", None, "", "A B!!\nA B!!\n\nx ### 12", "é" * 50, "\n\n", "one two two one " * 300, "last"]
    whole = statistics(pa.array(rows, pa.string()))
    assert whole.shape == (len(rows), len(STATISTICS)) and np.isfinite(whole).all()
    assert np.allclose(whole, np.concatenate([statistics(pa.array([r], pa.string())) for r in rows]))
    assert np.allclose(whole[1], whole[2])
    assert whole[6, 9] > whole[0, 9] and whole[3, 10] > whole[0, 10] and whole[3, 4] > whole[0, 4]


@pytest.mark.parametrize("first", [" one two two", "\tone two two", "\n\none two two", "   "])
def test_statistics_of_a_batch_that_begins_with_white_space(first):
    rows = [first, "one two two one " * 30, None, " one one"]
    whole = statistics(pa.array(rows, pa.string()))
    assert np.allclose(whole, np.concatenate([statistics(pa.array([r], pa.string())) for r in rows]))
    plain = statistics(pa.array(["one two two one " * 30], pa.string()))
    assert np.allclose(whole[1], plain[0])
    assert statistics(pa.array([" one one one"]))[0, 9] == statistics(pa.array(["one one one"]))[0, 9]


def test_rearranged_lines_are_no_repeats():
    at = STATISTICS.index("repeated_lines")
    lines = lambda *rows: statistics(pa.array(["\n".join(rows)]))[0, at]
    none = lines("a b c", "d e f", "g h i")
    assert lines("| 12 |", "| 21 |", "| 33 |") == lines("| 1221 |", "| 2112 |", "| 3003 |") == none
    assert lines("a b c", "d e f", "a b c") == lines("a b c", "a b c", "d e f") > none    # with and without a line break
    assert lines("a b c\r", "d e f\r", "a b c") == lines("a b c", "d e f", "a b c", "")
    assert statistics(pa.array(["1221 2112"]))[0, 9] == statistics(pa.array(["1221 3003"]))[0, 9]


def test_discriminant_equals_the_densities():
    rng = np.random.default_rng(2)
    x = [rng.standard_normal((400, 3)) @ np.diag([1, 2, 0.5]) + 1, rng.standard_normal((200, 3)) - 1]
    moments = np.stack([np.concatenate([[len(a)], a.sum(axis=0), (a.T @ a).ravel()]) for a in x])
    model = Discriminant.from_moments(moments, 0.0)
    at = rng.standard_normal((50, 3))
    logs = []
    for a in x:
        cov, d = np.cov(a.T, bias=True), at - a.mean(axis=0)
        logs.append(np.log(len(a) / 600) - np.log(np.linalg.det(cov)) / 2 - np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) / 2)
    assert np.allclose(model.score(at), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-4)
    flat = moments.copy()
    flat[0, 1:] = 0                                      # a class without any spread
    assert np.isfinite(Discriminant.from_moments(flat).score(at)).all()


def test_fit_uses_labels_of_all_rows_in_training(spark):
    rows = [(k, "good plain text here" if k % 2 else "### $$$ !!! ###") for k in range(200)]
    frame, _ = describe(texts(spark, rows + [(None, "x"), (1, "good plain text here")]))
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(200)] + [(3, None, 1), (4, 7, 1), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = fit(frame, labels)
    out, name = score_quality(frame, model)
    assert len([r for r in out.collect() if r.doc_id is not None and (r[name] > 0.5) == bool(r.doc_id % 2)]) == 201
    assert fit(frame, labels.limit(0)) is None and fit(frame, labels.filter("quality = 1")) is None


def test_nulls_empties_long_texts_repeats_and_clashing_columns(spark):
    rows = [(1, None, 0, 0), (2, "", 0, 0), (2, "", 0, 0), (None, "x", 0, 0), (3, "word " * 100_000, 0, 0)]
    frame = texts(spark, rows, ", score int, statistics int")
    described, name = describe(frame)
    assert name == "statistics_"
    out, score = score_quality(described, None, name)
    assert score == "score_" and [r[score] for r in out.collect()] == [0.5] * 5
    model = Discriminant.from_moments(np.stack([np.concatenate([[9], x.sum(0), (x.T @ x).ravel()]) for x in (
        np.random.default_rng(k).standard_normal((9, len(STATISTICS))) for k in (0, 1))]))
    got = score_quality(described, model, name)[0].collect()
    assert len(got) == 5 and len({r[score] for r in got if r.doc_id in (1, 2)}) == 1
    assert score_quality(describe(frame.limit(0))[0], model, name)[0].count() == 0


def plain(text):
    """All statistics by Python's own splitting."""
    raw = (text or "").encode()
    kind = lambda b: (1 if b in b"\t\n\v\f\r " else 2 if 65 <= b < 91 else 3 if 97 <= b < 123 or b > 127 else
                      4 if 48 <= b < 58 else 5 if b in b"!,.:;?'\"-()" else 0)
    n = [sum(kind(b) == k for b in raw) for k in range(6)]
    words, lines = re.findall(rb"[^\t-\r ]+", raw), []
    for at in re.finditer(rb"[^\n]+", raw):
        line = at[0]
        lines.append(line[:-1] if at.end() < len(raw) and line.endswith(b"\r") else line)
    logit = lambda part, whole, usual, w: np.log((part + usual * w) / (max(whole + w - part - usual * w, 0) + 0.01))
    w, s = len(words), len(raw)
    share = [logit(n[2], n[2] + n[3], .03, 200), logit(n[4], s, .005, 200), logit(n[5], s, .02, 200), logit(n[0], s, .003, 200),
             logit(n[1], s, .15, 200)]
    return [np.log(s + 200), *share, np.log((s - n[1] + 180) / (w + 30)),
            logit(sum(not any(kind(b) in (2, 3) for b in x) for x in words), w, .01, 30),
            logit(sum(any(kind(b) == 0 for b in x) for x in words), w, .01, 30), logit(w - len(set(words)), w, .2, 30),
            logit(len(lines) - len(set(lines)), len(lines), .05, 3), np.log((w + 60) / (len(lines) + 3)),
            logit(raw.count(b"!"), w, .005, 30)]


ODD = ["", "a", "\n", "\r\n", "a\r\nb\r\na\r", "x\r\n\r\n\nx\nx \r\n", "Ab! Ab!\tc\x0b12 ### é (a)\nAb! Ab!\n", " \n ", "\r\r\n\r",
       "word " * 30, "ab" * 40 + "\n" + "ab" * 40 + "\r\n" + "ab" * 40, "中文 文中 " * 9]


def test_statistics_equal_plain_counts_whole_and_in_pieces():
    rng = np.random.default_rng(5)
    rows = ODD + ["".join(rng.choice(list("aB 1!#\n\r\té"), 60)) for _ in range(150)]
    rows += [t for (t,) in duck("/root/testdata/sf0.001").execute("SELECT text FROM documents WHERE length(text) < 400 LIMIT 40").fetchall()]
    want = np.array([plain(t) for t in rows])
    assert np.allclose(statistics(pa.array(rows, pa.string())), want)
    for size in (1, 2, 5, 64, 10_000):
        got = np.concatenate([long_statistics(np.frombuffer((t or "").encode(), np.uint8), size) for t in rows])
        assert np.allclose(got, want), size


def test_a_very_long_text_needs_little_memory():
    rng = np.random.default_rng(6)
    some = " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(50_000)) + "\n"
    data = np.frombuffer((some * 110).encode(), np.uint8)
    tracemalloc.start()
    x = long_statistics(data)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(data) > 32_000_000 and most < 200_000_000
    assert np.allclose(x[0, STATISTICS.index("length")], np.log(len(data) + 200))


def test_long_and_short_texts_share_a_table(spark):
    rows = [(1, "some words here\n" * 100_000), (2, "some words here"), (3, "x" * 1_500_000)]
    described, name = describe(texts(spark, rows))
    got = {r.doc_id: r[name] for r in described.collect()}
    for k, t in rows:
        assert np.allclose(got[k], statistics(pa.array([t]))[0])


@pytest.mark.parametrize("labelled", [0, 1])
def test_one_class_only_gives_the_middle(spark, labelled):
    frame, _ = describe(texts(spark, [(k, "text") for k in range(20)]))
    labels = spark.createDataFrame([(k, labelled) for k in range(20)], "doc_id long, quality int")
    out, name = score_quality(frame, fit(frame, labels))
    assert {r[name] for r in out.collect()} == {0.5}
