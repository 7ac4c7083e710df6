"""A sample of registered queries against their DuckDB formulation (sf0.001).
The full set runs with ``python scripts/check_oracle.py``."""

import duckdb
import pytest

from scripts.check_oracle import TABLES, digest
from tests.conftest import SF_SMALL

KEYS = ["stg_families", "fact_snapshots", "fact_indicators", "mart_indicators", "mart_surveys",
        "chart_sankey", "m_pct_green", "s_avg_days_since_previous", "bq01_overall_status",
        "idx_q2_indicator_compare", "dq_not_null", "econ_pivot_wide", "pct_point_change"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    import __spark_entry__ as entry
    df = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    out = entry.entry(spark)
    assert out.columns == ["baseline_label", "current_label", "family_count"]
    assert out.count() >= 0
