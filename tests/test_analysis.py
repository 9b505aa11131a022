import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assay.operators import grading as G
from assay.operators import lift as L
from assay.operators import montecarlo as MC
from assay.operators import parity as PY
from assay.operators import predictor as P
from assay.operators import quality as Q
from assay.operators import recommend as R
from assay.operators import trades as TR
from tests.conftest import rows

SIG = ("symbol string, score_date date, score double, return_5d double, spy_5d_return double, beat_spy_5d int, return_10d double, "
       "spy_10d_return double, beat_spy_10d int, return_30d double, spy_30d_return double, beat_spy_30d int")


def signal(score, beat, day="2024-01-02", sym="a", r10=None):
    r = r10 if r10 is not None else (None if beat is None else float(beat))
    return (sym, day, score, None, None, None, r, 0.0, beat, None, None, None)


def test_score_bucket_edges(table):
    df = table(SIG, [signal(s, 1) for s in (59.9, 60, 69.99, 70, 80, 90, 100, 100.5, 101)])
    got = {r["bucket"]: r["n_10d"] for r in Q.accuracy_by_bucket(df).collect()}
    assert got == {"60-70": 2, "70-80": 1, "80-90": 1, "90+": 3}


def test_unresolved_rows_do_not_count(table):
    df = table(SIG, [signal(70, 1), signal(70, 0), signal(70, None)])
    r = Q.overall_accuracy(df, min_samples=2).first()
    assert (r["status"], r["n_10d"], r["accuracy_10d"], r["tp_10d"], r["fp_10d"], r["n_5d"]) == ("ok", 2, 0.5, 1, 1, 0)
    assert r["accuracy_5d"] is None and r["ci_low_5d"] is None
    r = Q.overall_accuracy(df, min_samples=3).first()
    assert (r["status"], r["n_10d"], r["accuracy_10d"]) == ("insufficient_data", 2, None)


def test_empty_input_gives_status_rows(table):
    empty = table(SIG, [])
    assert Q.overall_accuracy(empty).first()["status"] == "insufficient_data"
    assert Q.accuracy_by_bucket(empty).count() == 0 and Q.accuracy_by_threshold(empty).count() == 0
    assert Q.alpha_distribution(empty).count() == 0 and Q.alpha_summary(empty).count() == 0


def test_alpha_bucket_edges(table):
    df = table(SIG, [signal(70, 1, r10=x) for x in (-5.01, -5.0, -2.0, 0.0, 2.0, 5.0)])
    got = {r["bucket_no"]: r["count"] for r in Q.alpha_distribution(df, ["10d"], 1).collect()}
    assert got == {i: 1 for i in range(6)}


def test_threshold_tie_goes_to_the_lowest(table):
    df = table(SIG, [signal(60, 1)] * 30 + [signal(90, 1)] * 30)
    assert Q.optimal_threshold(df).first()["threshold"] == 60.0


def test_calibration_matches_qcut(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"symbol": "a", "score": rng.choice(np.arange(50, 100), 400).astype(float), "r": rng.normal(size=400)})
    df = spark.createDataFrame(pdf).select(
        "symbol", F.lit("2024-01-02").cast("date").alias("score_date"), "score", F.col("r").alias("return_10d"), F.lit(0.0).alias("spy_10d_return"),
        F.lit("X").alias("sector"))
    macro = spark.createDataFrame([], "date date, market_regime string")
    got = Q.score_calibration(df, macro).orderBy("bin").collect()
    cut = pd.qcut(pdf["score"], 5, duplicates="drop")
    assert [r["n"] for r in got] == cut.value_counts(sort=False).tolist()
    means = pdf.groupby(cut, observed=True)["r"].mean().round(2).tolist()
    assert [r["avg_alpha"] for r in got] == pytest.approx(means, abs=0.0051)
    assert got[0]["monotonic"] == all(a <= b for a, b in zip([r["avg_alpha"] for r in got], [r["avg_alpha"] for r in got][1:]))


def test_ranking_takes_k_per_date_with_ties(table):
    u = table("ticker string, eval_date date, return_5d double, beat_spy_5d int", [(t, "2024-01-02", i, 1) for i, t in enumerate("abcde")])
    c = table("ticker string, eval_date date, cio_decision string, final_score double", [
        ("a", "2024-01-02", "ADVANCE", 1), ("b", "2024-01-02", "ADVANCE", 9), ("c", "2024-01-02", "X", 7), ("d", "2024-01-02", "X", 7), ("e", "2024-01-02", "X", None)])
    r = L.committee_vs_ranking(u, c).first()
    assert (r["cio_avg"], r["ranking_avg"], r["avg_overlap"], r["n_picks"]) == (0.5, 1.5, 1.0, 2)  # b and c
    assert L.committee_vs_ranking(u, c.filter("cio_decision = 'X'")).first()["n_dates"] == 0


def test_blocked_row_that_was_traded_counts_as_selected(table):
    u = table("ticker string, eval_date date, return_5d double, beat_spy_5d int", [("a", "2024-01-02", 1, 1), ("b", "2024-01-02", -1, 0)])
    t = table("ticker string, date date, action string", [("a", "2024-01-02", "ENTER")])
    s = table("ticker string, date date", [("a", "2024-01-02"), ("b", "2024-01-02")])
    r = L.executor_lift(u, t, s).first()
    assert (r["n_traded"], r["n_approved"], r["tp"], r["tn"], r["fp"]) == (1, 3, 2, 1, 0)


def test_veto_sweep_and_choice(table):
    ddl = "symbol string, beat_spy_10d int, return_10d double, predicted_direction string, prediction_confidence double, sector string"
    rows_ = [("a", 0, -1, "DOWN", 0.7, "X")] * 15 + [("a", 1, 2, "DOWN", 0.55, "X")] * 5 + [("a", 0, -1, "DOWN", 0.4, "Y")] + [("a", 1, 1, "UP", 0.9, "X")] * 20
    m = table(ddl, rows_)
    got = {r["confidence"]: r for r in P.veto_thresholds(m).collect()}
    assert len(got) == 7 and got[0.8]["n_vetoes"] == 0 and got[0.8]["precision"] is None and got[0.8]["low_confidence"]
    assert (got[0.5]["n_vetoes"], got[0.5]["precision"], got[0.5]["missed_alpha"]) == (20, 0.75, 10.0)
    assert got[0.7]["recall"] == pytest.approx(15 / 16, abs=1e-4)  # the loser below every threshold is missed
    best = P.select_veto_threshold(P.veto_thresholds(m)).first()
    assert (best["status"], best["recommended_threshold"], best["cost_sensitivity"]) == ("ok", 0.6, "low")


def test_confusion_matrix_has_nine_cells(table):
    d = table("predicted_direction string, actual_5d_return double", [("UP", 0.01), ("UP", 0.005), ("DOWN", -0.2), (None, 1), ("FLAT", None)])
    got = {(r["predicted"], r["actual"]): r["n"] for r in P.confusion_matrix(d).collect()}
    assert len(got) == 9 and got[("UP", "UP")] == 1 and got[("UP", "FLAT")] == 1 and got[("FLAT", "DOWN")] == 0
    r = {x["direction"]: x for x in P.direction_rates(d, min_samples=1).collect()}
    assert (r["UP"]["precision"], r["UP"]["recall"], r["DOWN"]["f1"], r["FLAT"]["precision"]) == (0.5, 1.0, 1.0, None)
    assert P.direction_rates(d).count() == 0


def test_calibration_drops_thin_bins(table):
    d = table("prediction_date date, prediction_confidence double, correct_5d int",
              [("2024-01-02", 0.55, i % 2) for i in range(12)] + [("2024-01-02", 0.6, 1)] * 3 + [("2023-01-01", 0.55, 1)] * 50)
    bins = P.calibration_bins(d, "2024-01-10")
    assert {(r["bin"], r["n"], r["used"]) for r in bins.collect()} == {("0.5-0.6", 12, True), ("0.6-0.7", 3, False)}
    s = P.calibration_summary(bins).first()
    assert (s["n_total"], s["overall_ece"], s["calibration_quality"]) == (12, 0.05, "acceptable")
    assert P.calibration_summary(bins.filter("false")).first()["calibration_quality"] == "unknown"


def test_drift_of_a_flipped_feature(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(size=200)
    pdf = pd.DataFrame({"actual_5d_return": y, "good": y + rng.normal(size=200), "flip": -y, "flat": 1.0})
    ic = P.feature_ics(spark.createDataFrame(pdf), ["good", "flip", "flat"])
    train = spark.createDataFrame([("good", 0.5), ("flip", 0.4), ("flat", 0.1), ("gone", 0.1)], "feature string, ic double")
    got = {r["feature"]: r["status"] for r in P.feature_drift(ic, train).collect()}
    assert got["good"] == "stable" and got["flip"] == "sign_flip"
    assert P.drift_summary(P.feature_drift(ic, train)).first()["recommendation"] == "retrain_suggested"


def test_year_week_uses_calendar_year(table):
    d = table("d date", [("2024-12-30",), ("2023-01-01",)])
    assert [r[0] for r in d.select(P.year_week("d")).collect()] == ["2024-W01", "2023-W52"]


def test_exit_timing_capture(table):
    t = table("trade_id long, entry_trade_id long, date date, ticker string, action string, fill_price double, trigger_type string, "
              "realized_return_pct double, realized_alpha_pct double, days_held int, signal_price double", [
                  (1, None, "2024-01-02", "a", "ENTER", 100, None, None, None, None, None),
                  (2, 1, "2024-01-04", "a", "EXIT", 105, "stop", None, None, 2, None),
                  (3, 9, "2024-01-04", "a", "EXIT", 105, "stop", 1, None, 2, None)])
    bars = table("ticker string, date date, high double, low double", [("a", "2024-01-02", 101, 99), ("a", "2024-01-03", 110, 95), ("a", "2024-01-05", 500, 1)])
    r = TR.exit_timing(t, bars).collect()
    assert len(r) == 1 and (r[0]["mfe_pct"], r[0]["mae_pct"], r[0]["realized_return_pct"], r[0]["capture_ratio"]) == (10.0, -5.0, 5.0, 0.5)


def test_permutation_test_finds_a_real_effect(spark):
    rng = np.random.default_rng(7)
    n = 20
    pdf = pd.DataFrame([(f"t{i}", pd.Timestamp("2024-01-01") + pd.Timedelta(days=d), 70.0 + i, i / 10 + rng.normal() * 0.1, 0.0)
                        for d in range(8) for i in range(n)], columns=["ticker", "date", "score", "stock_return", "spy_return"])
    df = spark.createDataFrame(pdf).withColumn("date", F.to_date("date"))
    a = MC.permutation_test(df, 50, 3).first()
    b = MC.permutation_test(df.repartition(7, "ticker"), 50, 3).first()
    assert a == b and a["p_value"] == 0.0 and a["conclusion"] == "significant" and a["n_permutations"] == 50
    assert a["null_mean"] == pytest.approx(pdf["stock_return"].mean(), abs=0.15)
    assert MC.permutation_test(df.limit(10), 5, 3).first()["status"] == "insufficient_data"


def test_tolerances(spark):
    f = lambda a, b, rel, ab: spark.range(1).select(
        PY.within_tolerance(F.lit(a).cast("double"), F.lit(b).cast("double"), rel, ab)).first()[0]
    assert f(None, None, 0.1, 0) and not f(None, 1, 0.1, 0) and f(100, 100.1, 0.001, 0) and not f(100, 100.2, 0.001, 0)
    assert f(0, 0.4, 0.0, 0.5) and not f(0, 0.4, 0.1, 0.0)


def test_date_on_one_side_only(table):
    ddl = "signal_trading_day date, ticker string"
    live = table(ddl, [("2024-01-01", "a"), ("2024-01-01", "b")])
    other = table(ddl, [("2024-01-02", "a"), ("2024-01-01", "a"), ("2024-01-01", "b")])
    r = PY.count_divergence(live, other).collect()
    assert len(r) == 1 and (r[0]["live"], r[0]["replay"], r[0]["pct"]) == (0, 1, 1.0)
    assert PY.ticker_differences(live, other).count() == 0
    assert PY.ticker_differences(live, other, allowed=0).count() == 1


@pytest.mark.parametrize("share", [0.0, 0.3, 0.5, 0.7, 1.0])
def test_time_split_is_exact(spark, share):
    rng = np.random.default_rng(9)
    # a third of the rows on one day, most of those in one symbol
    pdf = pd.DataFrame({"d": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.where(rng.random(300) < 0.35, 5, rng.integers(0, 12, 300)), "D"),
                        "s": np.where(rng.random(300) < 0.6, "hot", rng.choice(["a", "z"], 300)), "i": np.arange(300)})
    df = spark.createDataFrame(pdf).withColumn("d", F.to_date("d")).repartition(6)
    got = {r["i"] for r in R.time_split(df, share, "d", "s", ["i"]).filter("in_train").collect()}
    want = set(pdf.sort_values(["d", "s", "i"])["i"].iloc[:int(300 * share + 1e-9)])
    assert got == want and R.time_split(df, share, "d", "s", ["i"]).count() == 300


def stats(table, rows_):
    return table("combo_id int, sharpe_ratio double, max_drawdown double, total_trades int, total_alpha double, p double", rows_)


def test_combo_recommendation_statuses(table):
    good = [(i, 1.0 + i / 10, -0.1, 60, 0.1, float(i)) for i in range(6)]
    run = lambda rs, cur=None: R.recommend_combo(R.ranked_combos(stats(table, rs), ["p"], cur or {"p": 0.0})).first()
    r = run(good)
    assert (r["status"], r["best_combo"], r["baseline_combo"], r["improvement"]) == ("ok", 5, 0, 0.5)
    assert run(good, {"p": 5.0})["status"] == "no_improvement"
    assert run(good[:3])["status"] == "insufficient_data"
    assert run([(*g[:3], 10, *g[4:]) for g in good])["status"] == "insufficient_trades"
    assert run([(g[0], -g[1], *g[2:]) for g in good])["status"] == "negative_sharpe"
    # the best combined score may have a lower Sharpe ratio; the gate looks at that row
    r = run([(0, 1.0, 0.0, 60, 0, 0), (1, 1.1, -0.9, 60, 0, 1)] + [(i, 0.1, 0.0, 60, 0, i) for i in range(2, 6)], {"p": 1.0})
    assert (r["best_combo"], r["status"]) == (0, "no_improvement")


def test_trigger_fallback_survives(table):
    t = table("trigger string, n_trades long, avg_realized_alpha double, win_rate_vs_spy double", [
        ("vwap", 60, -1, 0.5), ("time_expiry", 70, -1, 0.5), ("other", 10, -9, 0.0), ("(all)", 140, -1, 0.5)])
    assert rows(R.trigger_actions(t).select("trigger", "action")) == [("other", "keep"), ("time_expiry", "keep"), ("vwap", "disable")]


def test_trigger_reasons(table):
    ddl = "trigger string, n_trades long, avg_realized_alpha double, win_rate_vs_spy double, avg_slippage_vs_open double"
    t = table(ddl, [("a", 60, -0.01, 0.3, 0.21), ("b", 60, None, 0.5, 0.2), ("c", 49, -9.0, 0.0, 9.0), ("d", 50, -0.005, 0.4, None),
                    ("time_expiry", 60, 0.123456, 0.39, 0.3)])
    got = {r["trigger"]: (r["action"], r["reasons"], r["avg_alpha"], r["win_rate"]) for r in R.trigger_actions(t).collect()}
    assert got == {
        "a": ("disable", ["negative_alpha", "high_slippage", "low_win_rate"], -0.01, 0.3), "b": ("keep", [], None, 0.5),
        "c": ("keep", ["insufficient_data"], None, None), "d": ("keep", [], -0.005, 0.4),
        "time_expiry": ("disable", ["high_slippage", "low_win_rate"], 0.1235, 0.39)}
    alone = R.trigger_actions(t.filter("trigger = 'time_expiry'")).first()
    assert (alone["action"], alone["reasons"]) == ("keep", ["preserved_as_fallback"])


def test_regression_needs_a_baseline(table):
    ddl = "accuracy_10d double, sharpe_ratio double"
    now = table(ddl, [(0.5, 1.0)])
    assert R.regression_check(now, table(ddl, [])).first()["checked"] is False
    r = R.regression_check(now, table(ddl, [(0.56, 1.1)])).first()
    assert r["checked"] and r["regression_detected"] and r["accuracy_drop"] == 6.0
    assert not R.regression_check(now, table(ddl, [(0.54, 1.1)])).first()["regression_detected"]
    assert R.regression_check(now, table(ddl, [(0.5, -1.0)])).first()["sharpe_drop_pct"] is None


def test_retrain_grace_and_suppression(table):
    health = table("degradation_flag boolean, ic_ratio double, mode_collapse_flag boolean, share_up double, share_flat double, share_down double",
                   [(False, 0.9, True, 0.8, 0.1, 0.1)])
    drift, cal = table("drift_fraction double", [(0.1,)]), table("overall_ece double", [(0.2,)])
    reg = table("regime string, ic double", [("bear", -0.1), ("neutral", -0.2), ("bull", None)])
    names = lambda dep: {r["trigger"] for r in R.retrain_triggers(health, drift, cal, reg, "2024-02-01", dep).collect()}
    assert names("2024-01-20") == {"mode_collapse", "regime_negative_ic"}
    assert names("2023-01-20") == names(None) == {"mode_collapse", "regime_negative_ic", "calibration_breakdown"}
    t = R.retrain_triggers(health, drift, cal, reg, "2024-02-01")
    assert t.filter("trigger = 'regime_negative_ic'").first()["value"] == -0.2
    said = lambda d: R.alert_status(t, table("date date", [(d,)] if d else []), "2024-02-01").first()["decision"]
    assert (said("2024-01-31"), said("2024-01-30"), said(None)) == ("suppressed", "send", "send")


def test_grades_fall_back_without_precision(table):
    ddl = "component string, item string, metric string, value double"
    full = table(ddl, [("scanner", "", "precision", 0.65), ("scanner", "", "recall", 0.40), ("scanner", "", "lift", 0.0), ("scanner", "", "leakage", 0.0)])
    assert G.component_grades(full).first()["grade"] == pytest.approx((0.35 * 95 + 0.25 * 95 + 0.2 * 40 + 0.2 * 95))
    part = table(ddl, [("scanner", "", "precision", None), ("scanner", "", "recall", 0.40), ("scanner", "", "lift", 0.0), ("scanner", "", "leakage", None)])
    r = G.component_grades(part).first()
    assert (r["grade"], r["letter"]) == (40.0, "C-")
    none = table(ddl, [("macro", "", "accuracy_lift", None)])
    assert (G.component_grades(none).first()["letter"]) == "N/A"
    card = {r["name"]: r for r in G.scorecard(G.component_means(G.component_grades(full))).collect()}
    assert card["overall"]["status"] == "partial" and card["predictor"]["grade"] is None
    assert card["overall"]["grade"] == card["research"]["grade"]


def test_recommendation_gates(spark):
    dates = lambda n: spark.createDataFrame([(n,)], "n_dates long")
    lift = spark.createDataFrame([("t1", -0.02, 0.0, 9), ("t2", 0.02, 0.0, 9)], "team_id string, lift double, lift_vs_quant double, n_picks long")
    slots = spark.createDataFrame([("t1", 3), ("t2", 3)], "team_id string, slots int")
    few, enough = (R.team_slots(lift, slots, dates(n)).orderBy("team_id").collect() for n in (7, 8))
    assert [(r["status"], r["recommended_slots"]) for r in few] == [("insufficient_data", None)] * 2
    assert [(r["status"], r["recommended_slots"]) for r in enough] == [("ok", 2), ("ok", 4)]
    one = spark.createDataFrame([(-0.01,)], "lift double")
    assert R.committee_mode(one, one, dates(7)).first()["recommendation"] is None
    assert R.committee_mode(one, one, dates(8)).first()["recommendation"] == "deterministic"


def test_sweep_that_mostly_failed_is_not_judged(spark, table):
    low = spark.createDataFrame([(True,)], "low_completion boolean")
    cols = "combo_id int, p double, sharpe_ratio double, max_drawdown double, total_trades int, total_alpha double"
    rows_ = table(cols, [(i, float(i), 1.0 + i, -0.1, 90, 0.2) for i in range(6)])
    ranked = R.ranked_combos(rows_, ["p"], {"p": 0.0})
    assert R.recommend_combo(ranked).first()["status"] == "ok"
    assert R.recommend_combo(ranked, low).first()["status"] == "insufficient_data"


def test_holdout_leaves_a_refused_choice_as_it_was(spark, table):
    nav = table("combo_id int, date date, pos int, nav double", [(1, f"2024-01-{d + 1:02d}", d, 100.0 - d) for d in range(20)])
    for before, after in (("no_improvement", "no_improvement"), ("ok", "holdout_failed")):
        choice = spark.createDataFrame([(1, 2.0, before)], "best_combo int, best_sharpe double, status string")
        assert R.holdout_check(nav, choice).first()["status"] == after
