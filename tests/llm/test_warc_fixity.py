import pytest
from pyspark.sql import functions as F

from helpers import SF, duck, same
from mishap.llm import warc_fixity as W

MANIFEST = "page_id long, volume long, offset long, length long, digest string"


def manifest(spark, n=3000):
    rows = [(k, 0, 700 * k, 700, f"{k:064x}") for k in range(n)]
    return spark.createDataFrame(rows, MANIFEST)


def test_query_equals_oracle(spark):
    got = W.op2_warc_fixity(spark, SF)
    want = duck().execute(W.ORACLE)
    assert got.columns == [c[0] for c in want.description]
    same([tuple(r) for r in got.collect()], want.fetchall())


def test_equal_replicas_have_equal_roots(spark):
    a = manifest(spark)
    assert W.audit(a, a).count() == 0
    left, right = W.merkle_tree(a, "x"), W.merkle_tree(a.repartition(7), "y")
    assert left.levels[-1].collect() == right.levels[-1].collect() and left.levels[-1].count() == 1


def test_damage_is_located(spark):
    a = manifest(spark)
    changed = F.when(F.col("page_id") == 1234, F.lit("f" * 64)).otherwise(F.col("digest"))
    b = (a.withColumn("digest", changed).filter("page_id <> 7")
         .union(spark.createDataFrame([(9999, 0, 700 * 2999 + 5, 1, "e" * 64)], MANIFEST)))
    got = {(r.page_id, r.status, r.offset) for r in W.audit(a, b).collect()}
    assert got == {(1234, "corrupt", 700 * 1234), (7, "missing", 4900), (9999, "extra", 700 * 2999 + 5)}


@pytest.mark.parametrize("gone", ["a", "b", "both"])
def test_empty_replicas(spark, gone):
    some, none = manifest(spark, 3), manifest(spark, 3).limit(0)
    a, b = (none if gone in ("a", "both") else some), (none if gone in ("b", "both") else some)
    got = [r.status for r in W.audit(a, b).collect()]
    assert got == ([] if gone == "both" else ["extra" if gone == "a" else "missing"] * 3)


def test_archive_of_odd_pages(spark):
    rows = [(1, "u", "é<p>", 5), (1, "u", "é<p>", 6), (None, None, None, 7), (2, "", "", 8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, offset long")
    got = W.archive(pages).orderBy("offset").collect()
    assert [r.page_id for r in got] == [None, 1, 1, 2]
    assert [r.offset for r in got] == [0, *[sum(x.length for x in got[:k]) for k in (1, 2, 3)]]
    assert got[1].length == len("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: u\r\nContent-Length: 5\r\n\r\né<p>\r\n\r\n".encode())
    assert W.archive(pages.limit(0)).count() == 0


def test_a_damaged_null_page_is_reported(spark, tmp_path):
    pages = spark.createDataFrame([(7, "u", None), (57, None, ""), (8, "v", None), (11, "w", None)], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = {(r.page_id, r.status) for r in W.op2_warc_fixity(spark, str(tmp_path)).collect()}
    assert got == {(7, "corrupt"), (57, "corrupt"), (11, "missing")}
