import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from mishap.session import local_session
    s = local_session("mishap-tests", cores="*", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def clean_small(spark):
    from mishap.plans.registry import clean
    return clean(spark, SF_SMALL).cache()


@pytest.fixture(scope="session")
def stored_clean(spark):
    """The sf0.01 clean table written once to the shared folder, year-partitioned."""
    from mishap.plans.materialize import store_clean
    from mishap.plans.registry import clean
    return store_clean(clean(spark, SF_MID), "test-clean")


def rows(df, order=None):
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[k] is None, r[k]) for k in order))
    return out
