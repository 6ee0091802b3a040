"""Small tables and brute-force pieces for the tests of this folder."""

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def duck(sf_dir=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def documents(sf_dir=SF):
    return duck(sf_dir).execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def texts(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + more)


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))
