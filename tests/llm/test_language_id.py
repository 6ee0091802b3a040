import numpy as np
import pytest

from pyspark.sql import functions as F

from helpers import DOCS, duck
from mishap.llm.language_id import Network, fit, held_out, keep_identified, op6_language_id, predict, train, training_sample, words_of

SF = "/root/testdata/sf0.01"


def test_backpropagation_matches_finite_differences():
    rng = np.random.default_rng(3)
    net = Network.fresh(["a", "b", "c"], 4, rng)
    data, labels = rng.integers(0, 256, (5, 6)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}

    def loss():
        p, _, _ = net.probabilities(data)
        return -np.log(p[:, np.arange(5), labels]).mean()

    for name, g in net.gradients(data, labels).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        net.weights[name][at] += 1e-4
        up = loss()
        net.weights[name][at] -= 2e-4
        down = loss()
        net.weights[name][at] += 1e-4
        assert abs((up - down) / 2e-4 - g[at]) < 2e-3 * max(1, abs(g[at]))


def test_held_out_accuracy(spark):
    truth = dict(duck(SF).execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = op6_language_id(spark, SF).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_words_pool_whole_texts():
    assert words_of(" Ab\tÇd\n" + "x" * 70) == [b"ab", "çd".encode(), b"x" * 32, b"x" * 32, b"x" * 6]
    net = Network.fresh(["a", "b"], 3, np.random.default_rng(0))
    alone = np.concatenate([net.pooled([w]) for w in (b"ab", b"xyz", b"cd")])
    assert np.allclose(net.pooled([b"ab", b"xyz", b"cd"]), alone, atol=1e-5)
    assert np.allclose(alone[:, :-1].sum(axis=1), [2, 3, 2], atol=1e-5)


@pytest.fixture(scope="module")
def small(spark):
    rows = [(k, "the cat and the dog" if k % 2 else "le chat et le chien", "en" if k % 2 else "fr", "s", 1) for k in range(80)]
    odd = [(900, None, "en", "s", 1), (901, "", "en", "s", 1), (902, "123 ... !", None, "s", 1),
           (None, "the dog and the cat", "en", "s", 1), (3, "the cat and the dog", "en", "s", 1),
           (903, "et le chien " * 50_000, None, None, None)]
    return spark.createDataFrame(rows + odd, DOCS)


def test_nulls_empties_ties_long_texts_and_clashing_columns(spark, small):
    frame = small.selectExpr("*", "1 AS score", "'x' AS lang_pred")
    out, label, score = predict(frame, fit(small))
    assert (label, score) == ("lang_pred_", "score_") and out.columns == [*frame.columns, label, score]
    rows = out.collect()
    assert len(rows) == small.count()
    got = {r.doc_id: r for r in rows}
    assert [got[k][label] for k in (900, 901, 902)] == ["und"] * 3 and got[902][score] == 0
    assert got[None][label] == "en" and got[903][label] == "fr"
    assert keep_identified(small).columns == small.columns and keep_identified(small).count() == small.count() - 3


def test_nothing_to_learn_from(spark, small):
    assert train([]) is None and fit(small.limit(0)) is None
    out, label, _ = predict(small, None)
    assert {r[label] for r in out.collect()} == {"und"}
    assert predict(small.limit(0), fit(small))[0].count() == 0


def test_unlabelled_tables_keep_their_documents(spark, small):
    bare = small.withColumn("lang", F.lit(None).cast("string"))
    kept = keep_identified(bare)
    assert kept.columns == bare.columns and kept.count() == bare.count() - 3
    assert not {900, 901, 902} & {r.doc_id for r in kept.collect()}
    only_held = small.withColumn("lang", F.when(held_out(F.col("doc_id")), F.col("lang")))
    assert keep_identified(only_held.filter("doc_id is not null")).count() == small.count() - 4


def test_repeated_ids_and_rows_keep_the_sample_bounded(spark):
    key = next(k for k in range(9) if spark.range(1).select(held_out(F.lit(k))).first()[0] is False)
    rows = [(key, f"the cat and the dog {k}", "en", "s", 1) for k in range(1500)] + [(key, "le chat", "fr", "s", 1)] * 700
    rows += [(key, f"der hund {k}", "de", "s", 1) for k in range(30)]
    docs = spark.createDataFrame(rows, DOCS)
    got = [(r.lang, r.text) for r in training_sample(docs).collect()]
    assert len(set(got)) == len(got)
    assert [sum(lang == x for lang, _ in got) for x in ("en", "fr", "de")] == [400, 1, 30]
    assert fit(docs).languages == ["de", "en", "fr"]


def test_many_languages(spark):
    docs = spark.range(1200).selectExpr("id AS doc_id", "concat('word ', id % 300) AS text", "concat('l', id % 300) AS lang")
    got = training_sample(docs).groupBy("lang").count().collect()
    assert len(got) > 250 and max(r["count"] for r in got) <= 266


def test_the_prediction_fills_a_missing_language(spark, small):
    bare = small.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    was = {r.doc_id: r.lang for r in small.filter("doc_id < 100").collect()}
    kept = keep_identified(bare).filter("doc_id < 100 or doc_id = 903").collect()
    assert {r.doc_id: r.lang for r in kept if r.doc_id != 903} == was
    assert [r.lang for r in kept if r.doc_id == 903] == ["fr"]
