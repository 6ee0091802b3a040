import pytest

from helpers import SF, duck, same
from mishap.llm import url_filter as U


def test_query_equals_oracle(spark):
    got = U.op10_url_filter(spark, SF)
    want = duck().execute(U.ORACLE)
    same([tuple(r) for r in got.select(*[c[0] for c in want.description]).collect()], want.fetchall())


URLS = [("http://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("https://example.org/en/123", "example.org", "/en/123", "example.org/en/1", "block"),
        ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("x://www.shop.com/de/", "www.shop.com", "/de/", "com/de/", "block"),
        ("x://www.shop.com/DE/", "www.shop.com", "/DE/", None, "allow"),
        ("http://org", "org", "", None, "allow"), ("http://org?/", "org", "", None, "allow"),
        ("no scheme.com/de/", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
        ("http:///de/", "", "/de/", None, "allow"), ("a://b://com/de/", "b:", "//com/de/", None, "allow")]


def test_cases_nulls_repeats_and_clashing_columns(spark):
    rows = [(k, u[0], "old", "old", "old", "old") for k, u in enumerate(URLS)]
    frame = spark.createDataFrame(rows + rows[:2], "page_id long, url string, host string, path string, rule string, verdict string")
    got = U.judge_urls(frame).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == URLS[r.page_id][1:]


def test_long_urls_empty_table_and_no_rules(spark):
    long = "http://" + "a." * 5000 + "com/de/" + "x" * 100_000
    frame = spark.createDataFrame([(1, long)], "page_id long, url string")
    assert U.judge_urls(frame).first().rule == "com/de/"
    assert U.judge_urls(frame.limit(0)).count() == 0
    assert U.judge_urls(frame, ()).first().verdict == "allow"


@pytest.mark.parametrize("size", [1, 40, 700])
def test_cascade_is_exact(spark, size):
    keys = [f"k{n}" for n in range(4000)]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    listed = keys[:size * 3:3]
    levels = U.build_cascade(listed, universe)
    got = {r.key for r in universe.filter(U.member(universe.key, levels)).collect()}
    assert got == set(listed)
    assert sum(level.bits for level in levels) < 64 * (len(levels) + 1) + 20 * size


def test_native_plan(spark):
    plan = U.op10_url_filter(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Join"))
