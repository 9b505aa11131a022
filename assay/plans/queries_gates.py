"""Gated results that answer when their gate refuses: a status row each, passed and refused."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.operators import quality as Q
from assay.operators import trades as TR
from assay.plans.queries_predictor import NEVER, both, gates
from assay.plans.queries_quality import ALPHA_SPINE
from assay.plans.queries_trades import TIMED, timed
from assay.plans.registry import ORACLES, query

_EXITS = ["avg_mfe", "avg_mae", "avg_realized_return", "avg_capture_ratio", "median_mfe", "median_mae"]


@query("exit_timing_gate", gates("exit_timing_summary", f"SELECT count(*) AS n FROM {TIMED}", _EXITS, 5))
def _(t):
    rows = timed(t)
    return both(rows.agg(F.count("*").alias("n")), lambda k: TR.exit_timing_summary(rows, k), _EXITS, 5)


_GUARD = ["blocked_avg_return_5d", "traded_avg_return_5d", "precision", "recall", "guard_lift"]


@query("blocked_vs_traded_gate", gates("blocked_vs_traded", "SELECT count(*) AS n FROM {shadow_book}", _GUARD, 3))
def _(t):
    counts = t.shadow_book.agg(F.count("*").alias("n"))
    return both(counts, lambda k: TR.blocked_vs_traded(t.shadow_book, t.trades, t.universe_returns, k), _GUARD, 3)


_ALPHA = ["avg_alpha", "median_alpha", "std_alpha", "skew", "pct_positive"]


@query("alpha_summary_gate", " UNION ALL ".join(
    f"SELECT {k} AS least, s.horizon, CASE WHEN coalesce(a.n, 0) >= {k} THEN 'ok' ELSE 'insufficient_data' END AS status, "
    "coalesce(a.n, 0) AS n_samples, " + ", ".join(f"CASE WHEN a.n >= {k} THEN a.{m} END AS {m}" for m in _ALPHA)
    + " FROM (VALUES " + ", ".join(f"('{h}')" for h in Q.HORIZONS) + f") s(horizon) LEFT JOIN ({ORACLES['alpha_summary']}) a USING (horizon)"
    for k in (5, NEVER)))
def _(t):
    one = lambda k: Q.alpha_summary_status(t.scored_signals, min_samples=k).select(F.lit(k).alias("least"), "*")
    return one(5).unionByName(one(NEVER))


_BUCKET = ["count", "pct", "avg_alpha"]


@query("alpha_distribution_gate", " UNION ALL ".join(
    f"SELECT {k} AS least, s.horizon, b.bucket_no, b.bucket, CASE WHEN coalesce(n.n, 0) >= {k} THEN 'ok' ELSE 'insufficient_data' END AS status, "
    "coalesce(n.n, 0) AS n_samples, " + ", ".join(f"CASE WHEN n.n >= {k} THEN d.{m} END AS {m}" for m in _BUCKET)
    + " FROM (VALUES " + ", ".join(f"('{h}')" for h in Q.HORIZONS) + f") s(horizon) CROSS JOIN {ALPHA_SPINE} "
    f"LEFT JOIN (SELECT horizon, n FROM ({ORACLES['alpha_summary']})) n ON n.horizon = s.horizon "
    f"LEFT JOIN ({ORACLES['alpha_distribution']}) d ON d.horizon = s.horizon AND d.bucket_no = b.bucket_no"
    for k in (5, NEVER)))
def _(t):
    one = lambda k: Q.alpha_distribution_status(t.scored_signals, min_samples=k).select(F.lit(k).alias("least"), "*")
    return one(5).unionByName(one(NEVER))


_TRIGGER = ["avg_slippage_vs_signal", "avg_realized_alpha", "win_rate_vs_spy", "precision"]


@query("trigger_scorecard_gate", f"""SELECT trigger, CASE WHEN trigger = '(all)' OR n_trades >= 1000000000 THEN 'ok' ELSE 'insufficient_data' END AS status, n_trades,
 {', '.join(f"CASE WHEN trigger = '(all)' THEN {m} END AS {m}" for m in _TRIGGER)} FROM ({ORACLES['trigger_scorecard'].replace(' HAVING count(*) >= 3', '')})""")
def _(t):
    """A gate that no trigger passes; the row over all of them has none."""
    return TR.trigger_scorecard_status(t.trades, NEVER).select("trigger", "status", "n_trades", *_TRIGGER)
