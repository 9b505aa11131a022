"""Runs per variant, shared order paths and correlations, against plain Python."""

from __future__ import annotations

import math
import random
import statistics

import numpy as np
from pyspark.sql import functions as F

from assay.functions import scalars as S
from assay.functions.frames import with_status
from assay.operators import portfolio as PF
from assay.operators import recommend as R
from assay.operators import variants as V


def day(i):
    return f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}"


def test_cutoff_series_takes_the_best_of_what_passes(table):
    r = random.Random(2)
    rows = [(f"T{k}", day(d), r.choice([None, 0.0, 0.01, 0.02, 0.05]), r.randint(0, 4) * 1.0, r.random()) for d in range(12) for k in range(9)]
    rows.append(("Z", day(13), None, 1.0, 0.5))
    cuts = [0.0, 0.01, 0.03]
    found = {(x.cutoff, str(x.date)): (round(x.ret, 9), x.n) for x in V.cutoff_series(
        table("ticker string, date date, alpha double, score double, fwd double", rows), cuts, 3).collect()}
    assert len(found) == 13 * 3
    for c in cuts:
        for d in {x[1] for x in rows}:
            passed = sorted((-x[3], x[0], x[4]) for x in rows if x[1] == d and (c <= 0 or (x[2] is not None and x[2] >= c)))[:3]
            want = (round(statistics.fmean(x[2] for x in passed), 9), len(passed)) if passed else (0.0, 0)
            assert found[(c, d)] == want


def test_a_moved_cutoff_changes_its_sharpe_ratio(table):
    r = random.Random(4)
    rows = [(f"T{k}", day(d), k / 100, -float(k), 0.01 * k + r.gauss(0, 0.05)) for d in range(60) for k in range(8)]
    df = table("ticker string, date date, alpha double, score double, fwd double", rows)
    stats = {x.cutoff: x.sharpe_ratio for x in V.series_statistics(V.cutoff_series(df, [0.0, 0.03, 0.035], 2), "cutoff").collect()}
    assert stats[0.0] != stats[0.03] != stats[0.035]


def test_model_series_and_paired_statistics(table):
    rows = [("a", day(0), 1.0, 0.5, 0.10), ("b", day(0), 2.0, None, -0.20), ("c", day(0), 1.0, 9.0, None), ("a", day(1), 1.0, 1.0, 0.3), ("b", day(1), None, 2.0, 0.1)]
    df = table("ticker string, date date, x double, y double, ret double", rows)
    daily = V.model_series(df, {"x": F.col("x"), "y": F.col("y")}, "ret", 1)
    got = {(r.variant, str(r.date)): (r.ret, r.n) for r in daily.collect()}
    assert got == {("x", day(0)): (-0.2, 1), ("y", day(0)): (0.0, 1), ("x", day(1)): (0.3, 1), ("y", day(1)): (0.1, 1)}
    p = V.paired_statistics(daily, "x", "y").first()
    diffs = [0.2, -0.2]
    assert p.n_paired == 2 and p.mean_diff == 0.0 and p.t_stat == round(statistics.fmean(diffs) / statistics.stdev(diffs) * math.sqrt(2), 4)


def test_series_statistics_by_hand(table):
    rets = [0.01, -0.02, 0.03, 0.0]
    df = table("variant string, date date, ret double", [("v", day(i), x) for i, x in enumerate(rets)])
    s = V.series_statistics(df).first()
    nav = np.cumprod([1 + x for x in rets])
    assert s.n_dates == 4 and s.total_return == round(nav[-1] - 1, 6)
    assert s.sharpe_ratio == round(statistics.fmean(rets[1:]) / statistics.stdev(rets[1:]) * math.sqrt(252), 6)
    assert s.max_drawdown == -0.02


def test_weightings_use_the_same_total(table):
    df = table("date date, ret double, alpha double, weight double", [(day(0), 0.1, 0.1, 0.9), (day(0), -0.1, 0.0, 0.3), (day(1), 0.2, 0.2, 0.5)])
    got = {(r.variant, str(r.date)): round(r.ret, 9) for r in V.weighting_series(df).collect()}
    assert got == {("sized", day(0)): round((0.09 - 0.03) / 1.2, 9), ("equal", day(0)): 0.0, ("sized", day(1)): 0.1, ("equal", day(1)): 0.1}


ORDERS = "combo_id int, seq bigint, date date, ticker string, action string, shares double, price double"


def test_equity_from_bars_equals_marking_every_held_day(table):
    r = random.Random(11)
    cal = table("date date, pos int", [(day(i), i) for i in range(40)])
    bars = [(t, day(i), None if r.random() < 0.1 else r.uniform(50, 150), 200.0) for t in "abcd" for i in range(40) if r.random() < 0.5]
    orders = [(c, k, day(r.randrange(40)), r.choice("abcde"), r.choice(["ENTER", "ENTER", "EXIT", "REDUCE"]), float(r.randint(0, 9)), 100.0)
              for c in range(3) for k in range(40)]
    bars = table("ticker string, date date, close double, high double", bars)
    executed = PF.executed_orders(table(ORDERS, orders))
    plain = PF.nav_history(executed, cal, bars, marked=PF.marked_positions(executed, cal, bars))
    nav = lambda d: {(x.combo_id, x.pos): round(x.nav, 6) for x in d.collect()}
    assert nav(PF.nav_history(executed, cal, bars)) == nav(plain)


def test_combinations_of_one_path_share_its_statistics(table):
    combos = table("combo_id int, min_score double, max_position_pct double, atr_multiplier double",
                   [(i, 50.0 + 10 * (i % 2), 0.05 * (1 + i % 3), float(i)) for i in range(30)])
    paths = PF.order_paths(combos)
    assert paths.count() == 6
    trades = table("trade_id bigint, date date, ticker string, action string, shares int, fill_price double, position_pct double, exit_reason string, research_score double",
                   [(1, day(0), "a", "ENTER", 10, 5.0, 0.1, None, 55.0), (2, day(1), "a", "REDUCE", 10, 6.0, 0.1, None, 55.0), (3, day(0), "b", "ENTER", 7, 5.0, 0.1, None, 65.0)])
    got = {(x.combo_id, x.seq): x.shares for x in PF.orders_of(trades, combos).collect()}
    want = {}
    for i in range(30):
        score, pct = 50 + 10 * (i % 2), 0.05 * (1 + i % 3)
        for seq, action, shares, s in ((1, "ENTER", 10, 55), (2, "REDUCE", 10, 55), (3, "ENTER", 7, 65)):
            if s >= score:
                want[(i, seq)] = float(math.floor(shares * pct * 10 / 2 if action == "REDUCE" else shares * pct * 20))
    assert got == want
    stats = paths.withColumn("sharpe_ratio", F.col("min_score") + F.col("max_position_pct"))
    for x in PF.sweep_statistics(combos, stats).collect():
        assert x.sharpe_ratio == x.min_score + x.max_position_pct
    assert PF.sweep_statistics(combos, stats).count() == 30


def test_mean_correlation_of_a_group_equals_the_mean_over_its_pairs(table):
    r = random.Random(6)
    returns = [(t, i, None if r.random() < 0.2 else r.gauss(0, 0.02)) for t in "abcdef" for i in range(90) if r.random() < 0.6]
    returns += [("flat", i, 0.0) for i in range(90)]
    run = table("ticker string, pos int, ret double", returns)
    names = [(g, p, t) for g in (1, 2) for p in (0, 1, 2, 30, 61, 89) for t in ("b", "c", "d", "flat") if g == 1 or t != "c"]
    asked = [(g, p, t) for g in (1, 2, 3) for p in (0, 1, 2, 30, 61, 89) for t in ("a", "b", "flat")]
    found = {(x.g, x.pos, x.ticker): x["mean"] for x in PF.mean_correlations(
        table("g int, pos int, ticker string", asked), table("g int, pos int, ticker string", names), run, ["g"]).collect()}
    known = {(t, i): x for t, i, x in returns if x is not None}
    for g, p, t in asked:
        others = [b for gg, pp, b in names if (gg, pp) == (g, p) and b != t]
        if not p or not others:
            assert (g, p, t) not in found
            continue
        days = range(max(0, p - 60), p)
        series = lambda k: [known.get((k, i), 0.0) for i in days]  # noqa: B023, E731
        corr = []
        for b in others:
            x, y = series(t), series(b)
            live = len(x) >= 2 and statistics.stdev(x) > 1e-9 and statistics.stdev(y) > 1e-9
            corr.append(statistics.correlation(x, y) if live else 0.0)
        assert math.isclose(found[(g, p, t)], statistics.fmean(corr), abs_tol=1e-9)


def test_rounding_names_its_argument_once(spark):
    x = S.rnd(S.rnd(S.rnd(F.col("v"), 6), 4), 2)
    df = spark.createDataFrame([(1.005,), (-2.5,), (-0.001,), (float("nan"),), (float("inf"),), (1e17,), (None,)], "v double")
    got = [r[0] for r in df.select(x).collect()]
    assert got[:3] == [1.01, -2.5, 0.0] and math.copysign(1, got[2]) == 1
    assert math.isnan(got[3]) and got[4] == math.inf and math.isclose(got[5], 1e17, rel_tol=1e-15) and got[6] is None
    plan = df.select(x.alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.splitlines()[0].count("v#") == 1


def test_stability_looks_at_runs_exactly_weeks_before(table):
    rows = [("q", "2024-01-01", 0.5), ("q", "2024-01-08", 0.6), ("q", "2024-01-15", 0.4), ("q", "2024-01-22", 0.4), ("q", "2024-01-29", 0.3),
            ("q", "2024-02-12", 0.5), ("q", "2024-02-13", 0.9), ("q", "2024-02-19", None), ("q", "2024-02-26", 0.1)]
    found = {str(x.run_date): (x.weeks_loaded, x.n_reversals, x.stable) for x in R.weight_stability(
        table("sub_score string, run_date date, weight double", rows)).collect()}
    assert found == {
        "2024-01-01": (0, 0, True), "2024-01-08": (1, 0, True), "2024-01-15": (2, 1, False), "2024-01-22": (3, 1, False),
        "2024-01-29": (3, 0, True),  # 0.6, 0.4, 0.4, 0.3: a zero step between two falls
        "2024-02-12": (2, 1, False),  # 0.4, 0.3, 0.5: the run a week before is absent
        "2024-02-13": (0, 0, True), "2024-02-19": (2, 0, True), "2024-02-26": (2, 0, True)}


def test_a_refused_gate_still_answers(table):
    counts, result = table("n bigint", [(7,)]), table("status string, x double", [("whatever", 2.5)])
    assert tuple(with_status(counts, result, 5).first()) == ("ok", 7, 2.5)
    assert tuple(with_status(counts, result.filter("false"), 8).first()) == ("insufficient_data", 7, None)
