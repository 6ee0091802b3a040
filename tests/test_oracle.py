"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from mishap.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    from scripts.check_oracle import duck as open_duck
    return open_duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    from scripts.check_oracle import rows_of
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    cur = duck.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert rows_of(df.columns, got) == rows_of(cols, want)


def test_every_query_has_an_oracle():
    from oracle_sql import ORACLE
    assert set(ORACLE) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["city", "High", "Low", "Medium", "Other", "total"]
    out = df.collect()
    assert 0 < len(out) <= 5
    assert all(r.total == r.High + r.Low + r.Medium + r.Other for r in out)


def test_entry_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
