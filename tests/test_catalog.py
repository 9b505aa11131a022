"""Registered queries against their SQL oracle on the smallest data, and plan shapes."""

import math
import os

import duckdb
import pytest

from assay.plans import catalog
from assay.plans.views import BASE

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")

SAMPLE = [
    "signal_quality_by_bucket", "alpha_summary", "sub_score_correlations", "committee_vs_ranking", "team_lift", "trigger_scorecard",
    "veto_value", "nearest_prediction", "feature_drift", "predictor_sizing", "price_matrix", "synthetic_signals", "flat_signal_records",
    "combo_statistics", "entry_decisions", "exit_decisions", "parity_metrics", "weight_suggestion", "opening_positions",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)):
        return "NaN" if math.isnan(v) else round(float(v), 7) + 0.0
    return str(v)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    cur = con.execute(catalog.ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    key = sorted(cols)
    got = sorted((tuple(norm(r[c]) for c in key) for r in df.collect()), key=repr)
    want = sorted((tuple(norm(r[cols.index(c)]) for c in key) for r in cur.fetchall()), key=repr)
    assert got == want


def test_every_oracle_belongs_to_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES) and len(catalog.QUERIES) > 150


def plan(spark, name):
    return catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["attribution_table", "nearest_prediction", "exit_timing_trades", "committee_vs_ranking", "round_trips",
                                  "price_matrix", "features_carried_forward", "team_lift", "entry_decisions"])
def test_no_cartesian_join(spark, name):
    assert "CartesianProduct" not in plan(spark, name)


def test_top_n_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(spark, "top_n_alpha")


def test_scan_reads_only_needed_columns(spark):
    text = plan(spark, "price_fill_rate") + plan(spark, "universe_freshness")
    assert "props" not in text
