"""Registered queries against their DuckDB oracle (the driver's gate, locally).

By default a representative subset runs on sf0.001; set TILLCAST_FULL_ORACLE=1
to run every query that has an oracle.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

SUBSET = ["fc_snaive", "rmse_per_item_mean", "leaderboard", "mape", "pivot_submission", "melt_sales",
          "feature_table", "join_price", "event_lags", "acf_weekly", "count_histogram", "profile_numeric",
          "future_regressors", "gram_ar", "dynreg_ols", "ts_folds", "group_ts_folds", "surrogate_ids",
          "weekly_calendar", "yearago_snap", "one_hot_long", "poisson_leaf_values", "fc_ses"]
NAMES = sorted(E.oracle_sql()) if os.environ.get("TILLCAST_FULL_ORACLE") else SUBSET


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, res.fetchall())


def test_every_query_has_a_callable_and_known_oracle_names():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 120


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["model", "rmse", "n_items"] and len(rows) == 1
