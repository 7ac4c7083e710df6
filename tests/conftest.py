import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from surveywave import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def wh_small(spark):
    from surveywave.plans.warehouse import warehouse_for
    return warehouse_for(spark, SF_SMALL)


def rows(df, *cols):
    """Collected rows as tuples (sorted), optionally projected."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))
