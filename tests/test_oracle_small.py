"""DataFrame queries vs their DuckDB oracle text on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import compare, duck  # noqa: E402

from valuescope.plans.catalog import load_all  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = ["clean_transactions", "cleaning_waterfall", "customer_features", "customer_features_events",
         "cohort_retention", "pareto_summary", "rfm_segments", "clv_scores_fixed", "targeting_list",
         "roi_curve", "churn_labels", "churn_risk_metrics"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    q = load_all()[name]
    df = q.build(spark, SF)
    srows = [r.asDict() for r in df.collect()]
    cur = con.execute(q.sql)
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    res = compare(srows, df.columns, drows, dcols)
    assert res["schema"], res
    assert res["rows"][0] == res["rows"][1], res
    assert res["r9"], res


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
