"""Every registered query against its DuckDB oracle on the smallest scale
factor (value-exact after rounding); queries without an oracle must run."""

import pytest

from panelkit.plans import ORACLES, QUERIES
from panelkit.testing import compare, duck
from tests.conftest import SF_SMALL

# 40 and 4 boosted fits: run by the driver's correctness pass, too slow for a unit test
SLOW = {"ml7_grid_search_cv", "ml8_compare_models"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, QUERIES[name], ORACLES[name], con)
    assert r["cols_match"], r
    assert r["types_match"], r.get("type_diff")
    assert r["exact"], {k: v for k, v in r.items() if k != "spark_cols"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()  # every column is computed
    assert rows and all(len(r) == len(df.columns) for r in rows)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
