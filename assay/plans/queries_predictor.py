"""Predictor queries with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.functions.scalars import direction_of
from assay.operators import predictor as P
from assay.plans.queries_quality import pearson_sql, wilson
from assay.functions.frames import with_status
from assay.plans.registry import ORACLES, query
from assay.plans.views import r

MATCHED = """(SELECT s.*, p.prediction_date AS matched_date, p.predicted_direction, p.prediction_confidence
  FROM (SELECT * FROM {scored_signals} WHERE beat_spy_10d IS NOT NULL) s ASOF LEFT JOIN {predictor_outcomes} p
  ON s.symbol = p.symbol AND p.prediction_date <= s.score_date)"""


def matched(t):
    """Matched signals with the columns that some query of them reads; the others are not shuffled."""
    signals = t.scored_signals.select("symbol", "score_date", "score", "sector", "beat_spy_10d", "return_10d")
    return t.kept("matched_predictions", lambda: P.nearest_prediction(signals, t.predictor_outcomes))


@query("nearest_prediction", f"""SELECT symbol, CAST(score_date AS VARCHAR) AS score_date, score, beat_spy_10d, return_10d, CAST(matched_date AS VARCHAR) AS matched_date,
  predicted_direction, prediction_confidence FROM {MATCHED}""")
def _(t):
    return matched(t).select(
        "symbol", "score_date", "score", "beat_spy_10d", "return_10d", "matched_date", "predicted_direction",
        "prediction_confidence")


@query("veto_direction_distribution", f"""SELECT coalesce(predicted_direction, 'UNKNOWN') AS direction, count(*) AS n FROM {MATCHED} WHERE matched_date IS NOT NULL GROUP BY 1""")
def _(t):
    return P.direction_distribution(matched(t))


_lo, _hi = wilson("count(CASE WHEN beat_spy_10d = 0 THEN 1 END)", "count(beat_spy_10d)")
_TN, _FN, _NV = "count(CASE WHEN beat_spy_10d = 0 THEN 1 END)", "count(CASE WHEN beat_spy_10d = 1 THEN 1 END)", "count(beat_spy_10d)"
_PR, _RC = f"({_TN} * 1e0 / nullif({_NV}, 0))", f"(CASE WHEN {_NV} > 0 THEN {_TN} * 1e0 / nullif(max(losers), 0) END)"
_MISS = "coalesce(sum(CASE WHEN beat_spy_10d = 1 THEN return_10d END), 0e0)"
SWEEP = f"""(SELECT c AS confidence, {_NV} AS n_vetoes, {_TN} AS true_negatives, {_FN} AS false_negatives, {r(_PR, 4)} AS precision, {r(_RC, 4)} AS recall,
   {r(f'2 * {_PR} * {_RC} / nullif({_PR} + {_RC}, 0)', 4)} AS f1, {_lo} AS ci_low, {_hi} AS ci_high, {_NV} < 30 AS low_confidence, {r(_MISS, 4)} AS missed_alpha,
   {r(f'coalesce({_MISS} / nullif({_FN}, 0), 0e0)', 4)} AS missed_alpha_per_winner, {r(f'{_PR} - max(base)', 4)} AS lift, {r('max(base)', 4)} AS base_rate
 FROM (VALUES (0.5e0), (0.55e0), (0.6e0), (0.65e0), (0.7e0), (0.75e0), (0.8e0)) t(c)
 CROSS JOIN (SELECT avg(beat_spy_10d) AS base, count(CASE WHEN predicted_direction = 'DOWN' AND beat_spy_10d = 0 THEN 1 END) AS losers FROM {MATCHED}) b
 LEFT JOIN (SELECT prediction_confidence AS pc, beat_spy_10d, return_10d FROM {MATCHED} WHERE predicted_direction = 'DOWN') d ON d.pc >= t.c GROUP BY c)"""


@query("veto_threshold_sweep", f"SELECT * FROM {SWEEP}")
def _(t):
    return P.veto_thresholds(matched(t))


def _pick(w, col):
    return f"max_by({col}, CASE WHEN ok THEN {{{{s}}}} END)".replace("{{s}}", f"row(precision - {w} * cost, -confidence)")


_SEL = f"""SELECT CASE WHEN n_scoreable = 0 THEN 'insufficient_vetoes' WHEN lift < 0.05e0 THEN 'insufficient_lift' ELSE 'ok' END AS status, 0.6e0 AS current_threshold, base_rate,
  c0 AS recommended_threshold, precision, recall, lift, missed_alpha, n_vetoes, CASE WHEN nd > 2 THEN 'high' WHEN nd = 1 THEN 'low' ELSE 'moderate' END AS cost_sensitivity
FROM (SELECT a.*, b.*, len(list_distinct([c1, c2, c3, c4])) AS nd FROM
  (SELECT count(CASE WHEN ok THEN 1 END) AS n_scoreable, max(base_rate) AS base_rate,
    {', '.join(f'(SELECT confidence FROM x WHERE ok ORDER BY precision - {w}e0 * cost DESC, confidence LIMIT 1) AS c{i}' for i, w in enumerate([0.3, *P.COST_WEIGHTS]))} FROM x) a
  LEFT JOIN (SELECT precision, recall, lift, missed_alpha, n_vetoes FROM x WHERE ok ORDER BY precision - 0.3e0 * cost DESC, confidence LIMIT 1) b ON true)"""


@query("veto_threshold_selection", f"""WITH x AS (SELECT *, n_vetoes >= 10 AS ok, abs(missed_alpha) / greatest(max(CASE WHEN n_vetoes >= 10 THEN abs(missed_alpha) END) OVER (), 1e-300) AS cost FROM {SWEEP}) {_SEL}""")
def _(t):
    return P.select_veto_threshold(P.veto_thresholds(matched(t)))


@query("veto_by_sector", f"""SELECT sector, count(*) AS n_down, count(CASE WHEN h THEN 1 END) AS n_vetoes,
  {r('count(CASE WHEN h AND beat_spy_10d = 0 THEN 1 END) * 1e0 / nullif(count(CASE WHEN h THEN 1 END), 0)', 4)} AS precision,
  {r('CASE WHEN count(CASE WHEN h THEN 1 END) > 0 THEN count(CASE WHEN h AND beat_spy_10d = 0 THEN 1 END) * 1e0 / nullif(count(CASE WHEN beat_spy_10d = 0 THEN 1 END), 0) END', 4)} AS recall
 FROM (SELECT *, prediction_confidence >= 0.6e0 AS h FROM {MATCHED} WHERE predicted_direction = 'DOWN') WHERE sector IS NOT NULL GROUP BY 1""")
def _(t):
    return P.veto_by_sector(matched(t), 0.6)


_KNOWN = "(SELECT *, predicted_direction AS p, CASE WHEN actual_5d_return > 0.5e0 THEN 'UP' WHEN actual_5d_return < -0.5e0 THEN 'DOWN' ELSE 'FLAT' END AS a FROM {predictor_outcomes} WHERE predicted_direction IS NOT NULL AND actual_5d_return IS NOT NULL)"
_DIRS = "(VALUES ('UP'), ('FLAT'), ('DOWN'))"


@query("actual_directions", f"SELECT symbol, a AS actual, count(*) AS n FROM {_KNOWN} GROUP BY 1, 2")
def _(t):
    """Returns turned into directions (outcomes in percent points), counted per symbol."""
    known = t.predictor_outcomes.filter("predicted_direction IS NOT NULL AND actual_5d_return IS NOT NULL")
    return known.groupBy("symbol", direction_of("actual_5d_return", 0.5).alias("actual")).agg(F.count("*").alias("n"))


@query("confusion_matrix", f"""SELECT x.d AS predicted, y.d AS actual, count(k.p) AS n FROM {_DIRS} x(d) CROSS JOIN {_DIRS} y(d) LEFT JOIN {_KNOWN} k ON k.p = x.d AND k.a = y.d GROUP BY 1, 2""")
def _(t):
    return P.confusion_matrix(t.predictor_outcomes, band=0.5)


_p, _r = "(tp * 1e0 / nullif(np, 0))", "(tp * 1e0 / nullif(na, 0))"


@query("direction_rates", f"""SELECT d AS direction, {r(_p, 4)} AS precision, {r(_r, 4)} AS recall, {r(f'2 * {_p} * {_r} / nullif({_p} + {_r}, 0)', 4)} AS f1, np AS n_predicted, na AS n_actual, tp, acc AS accuracy
 FROM (SELECT d, count(CASE WHEN p = d THEN 1 END) AS np, count(CASE WHEN a = d THEN 1 END) AS na, count(CASE WHEN p = d AND a = d THEN 1 END) AS tp,
   {r('avg(CASE WHEN p = a THEN 1e0 ELSE 0e0 END)', 4)} AS acc FROM {_DIRS} x(d) CROSS JOIN {_KNOWN} k GROUP BY d)""")
def _(t):
    return P.direction_rates(t.predictor_outcomes, band=0.5)


_ON, _OFF = "final_score >= 60", "combined_score >= 60"


def _a(c, d=4):
    return r(f"avg({c})", d)


@query("macro_evaluation", f"""SELECT *, {r('with_accuracy - without_accuracy', 4)} AS accuracy_lift, {r('with_alpha - without_alpha', 4)} AS alpha_lift,
  CASE WHEN with_accuracy - without_accuracy IS NULL THEN 'insufficient_data' WHEN {r('with_accuracy - without_accuracy', 4)} > 0.02e0 THEN 'helps'
       WHEN {r('with_accuracy - without_accuracy', 4)} < -0.02e0 THEN 'hurts' ELSE 'neutral' END AS assessment FROM (
 SELECT count(*) AS n_evaluated, {_a(f'CASE WHEN {_ON} THEN beat_spy_5d END')} AS with_accuracy, {_a(f'CASE WHEN {_ON} THEN al END')} AS with_alpha, count(CASE WHEN {_ON} THEN 1 END) AS with_n,
  {_a(f'CASE WHEN {_OFF} THEN beat_spy_5d END')} AS without_accuracy, {_a(f'CASE WHEN {_OFF} THEN al END')} AS without_alpha, count(CASE WHEN {_OFF} THEN 1 END) AS without_n,
  {_a('macro_shift')} AS avg_shift, max(macro_shift) AS max_shift, min(macro_shift) AS min_shift, {r('stddev_samp(macro_shift)', 4)} AS std_shift,
  count(CASE WHEN macro_shift > 0 THEN 1 END) AS n_positive, count(CASE WHEN macro_shift < 0 THEN 1 END) AS n_negative, count(CASE WHEN macro_shift = 0 THEN 1 END) AS n_zero,
  count(CASE WHEN {_ON} AND NOT {_OFF} THEN 1 END) AS n_promoted, count(CASE WHEN {_OFF} AND NOT {_ON} THEN 1 END) AS n_demoted,
  {_a(f'CASE WHEN {_ON} AND NOT {_OFF} THEN al END')} AS promoted_avg_alpha, {_a(f'CASE WHEN {_OFF} AND NOT {_ON} THEN al END')} AS demoted_avg_alpha
 FROM (SELECT c.*, u.beat_spy_5d, u.return_5d - u.spy_return_5d AS al FROM {{cio_evaluations}} c JOIN {{universe_returns}} u USING (ticker, eval_date)
       WHERE c.combined_score IS NOT NULL AND c.final_score IS NOT NULL AND u.return_5d IS NOT NULL))""")
def _(t):
    return P.macro_evaluation(t.cio_evaluations, t.universe_returns)


ASOF = "2001-08-01"


def recent_sql(days: int) -> str:
    return f"(SELECT *, coalesce(p_up, 0) - coalesce(p_down, 0) AS net FROM {{predictor_outcomes}} WHERE correct_5d IS NOT NULL AND prediction_date >= DATE '{ASOF}' - {days})"


@query("production_health", f"""SELECT *, coalesce(ic_ratio < 0.5e0, false) AS degradation_flag, greatest(share_up, share_flat, share_down) > 0.75e0 AS mode_collapse_flag FROM (
 SELECT *, 0.3e0 AS training_ic, {r('rolling_ic / 0.3e0', 2)} AS ic_ratio FROM (
  SELECT count(*) AS n_resolved, {r(pearson_sql('net', 'actual_5d_return', 10), 4)} AS rolling_ic, {_a('correct_5d')} AS hit_rate,
   {', '.join(r(f"count(CASE WHEN predicted_direction = '{d}' THEN 1 END) * 1e0 / count(predicted_direction)", 3) + f' AS share_{d.lower()}' for d in P.DIRECTIONS)} FROM {recent_sql(120)}))""")
def _(t):
    return P.production_health(t.predictor_outcomes, ASOF, training_ic=0.3, lookback_days=120)


@query("regime_ic", f"""SELECT x.regime, coalesce(n, 0) AS n, ic FROM (VALUES ('bull'), ('neutral'), ('bear'), ('caution')) x(regime) LEFT JOIN (
  SELECT market_regime AS regime, count(actual_5d_return) AS n, {r(pearson_sql('net', 'actual_5d_return', 10), 4)} AS ic FROM {recent_sql(400)} o JOIN {{macro_snapshots}} m ON o.prediction_date = m.date GROUP BY 1) USING (regime)""")
def _(t):
    return P.regime_ic(t.predictor_outcomes, t.macro_snapshots, ASOF, lookback_days=400)


_BIN = "CASE WHEN prediction_confidence >= 0.5e0 AND prediction_confidence < 0.6e0 THEN '0.5-0.6' WHEN prediction_confidence >= 0.6e0 AND prediction_confidence < 0.7e0 THEN '0.6-0.7' WHEN prediction_confidence >= 0.7e0 AND prediction_confidence < 0.8e0 THEN '0.7-0.8' WHEN prediction_confidence >= 0.8e0 AND prediction_confidence < 0.9e0 THEN '0.8-0.9' WHEN prediction_confidence >= 0.9e0 AND prediction_confidence < 1.01e0 THEN '0.9-1.0' END"
BINS = f"(SELECT * FROM (SELECT {_BIN} AS bin, count(*) AS n, avg(correct_5d) AS hit_rate, avg(prediction_confidence) AS expected, count(*) >= 15 AS used FROM {recent_sql(60)} GROUP BY 1) WHERE bin IS NOT NULL)"


@query("calibration_bins", f"SELECT bin, n, {r('hit_rate', 3)} AS hit_rate, {r('expected', 3)} AS expected, used FROM {BINS}")
def _(t):
    return P.calibration_table(P.calibration_bins(t.predictor_outcomes, ASOF, min_bin=15))


_ECE = r("sum(CASE WHEN used THEN abs(hit_rate - expected) * n END) / sum(CASE WHEN used THEN n END)", 4)


@query("calibration_summary", f"""SELECT *, CASE WHEN overall_ece IS NULL THEN 'unknown' WHEN overall_ece < 0.05e0 THEN 'good' WHEN overall_ece < 0.1e0 THEN 'acceptable' ELSE 'poor' END AS calibration_quality FROM (
 SELECT CAST(coalesce(sum(CASE WHEN used THEN n END), 0) AS BIGINT) AS n_total, count(CASE WHEN used THEN 1 END) AS n_bins, count(CASE WHEN NOT used THEN 1 END) AS n_dropped, {_ECE} AS overall_ece FROM {BINS})""")
def _(t):
    return P.calibration_summary(P.calibration_bins(t.predictor_outcomes, ASOF, min_bin=15))


@query("rolling_metrics", f"""
WITH v AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS rn, count(*) OVER () AS m FROM {recent_sql(200)} WHERE actual_5d_return IS NOT NULL),
z AS (SELECT *, greatest(2, m // 5) AS nc FROM v), y AS (SELECT *, rn // (m // nc) AS chunk FROM z),
c AS (SELECT chunk, {pearson_sql('net', 'actual_5d_return', 2)} AS c FROM y WHERE chunk < nc GROUP BY 1)
SELECT a.*, b.* FROM (SELECT count(*) AS rolling_n, {_a('correct_5d')} AS hit_rate, {r(pearson_sql('net', 'actual_5d_return', 10), 4)} AS ic FROM {recent_sql(200)}) a,
 (SELECT count(*) AS n_chunks, {r('avg(c) / (stddev_pop(c) + 1e-8)', 3)} AS ic_ir FROM c) b""")
def _(t):
    return P.rolling_metrics(t.predictor_outcomes, ASOF, lookback_days=200)


FEATURES = ["atr_14_pct", "rsi_14", "momentum_20d", "upside_gap", "breadth"]
JOINED = """(SELECT o.*, f.date AS matched_date, f.atr_14_pct, f.rsi_14, f.momentum_20d, f.upside_gap, f.breadth FROM (SELECT * FROM {event_outcomes} WHERE actual_5d_return IS NOT NULL) o
  ASOF JOIN {features} f ON o.symbol = f.ticker AND f.date <= o.prediction_date)"""


def _outcomes(t):
    return t.event_outcomes.filter("actual_5d_return IS NOT NULL")


def _joined(t):
    return t.kept("outcome_features", lambda: P.outcomes_with_features(
        _outcomes(t), t.features.filter("day(date) % 3 <> 0"), FEATURES, "last_id"))


_J3 = JOINED.replace("ASOF JOIN {features} f", "ASOF JOIN (SELECT * FROM {features} WHERE day(date) % 3 <> 0) f")


@query("outcomes_with_features", f"SELECT * REPLACE (CAST(prediction_date AS VARCHAR) AS prediction_date, CAST(matched_date AS VARCHAR) AS matched_date) FROM {_J3}")
def _(t):
    """Features are only known on two days of three, so that prior rows get used."""
    return _joined(t)


_LONG = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS x, actual_5d_return AS y, prediction_date FROM j" for f in FEATURES)


def spearman_sql(rows: str, g: str) -> str:
    return f"""SELECT {g}, count(*) AS n, CASE WHEN stddev_samp(rx) > 1e-9 AND stddev_samp(ry) > 1e-9 THEN covar_samp(rx, ry) / (stddev_samp(rx) * stddev_samp(ry)) END AS ic FROM (
   SELECT {g}, rank() OVER (PARTITION BY {g} ORDER BY x) + (count(*) OVER (PARTITION BY {g}, x) - 1) / 2e0 AS rx, rank() OVER (PARTITION BY {g} ORDER BY y) + (count(*) OVER (PARTITION BY {g}, y) - 1) / 2e0 AS ry
   FROM ({rows}) WHERE x IS NOT NULL AND y IS NOT NULL) GROUP BY {g}"""


@query("feature_rank_correlations", f"WITH j AS {_J3}, l AS ({_LONG}) SELECT feature, n, {r('ic')} AS ic FROM ({spearman_sql('SELECT * FROM l', 'feature')}) WHERE n >= 20")
def _(t):
    return P.feature_ics(_joined(t), FEATURES)


def _drift(t):
    late = F.col("prediction_date") >= F.lit("2024-01-16").cast("date")
    ics = P.feature_ics(_joined(t).withColumn("late", late), FEATURES, by=["late"])
    return P.feature_drift(ics.filter("late").drop("late"), ics.filter("NOT late").drop("late"))


_DRIFT = f"""j AS {_J3}, l AS ({_LONG}),
 a AS (SELECT feature, n, {r('ic')} AS ic FROM ({spearman_sql("SELECT * FROM l WHERE prediction_date < DATE '2024-01-16'", 'feature')}) WHERE n >= 20),
 b AS (SELECT feature, n, {r('ic')} AS ic FROM ({spearman_sql("SELECT * FROM l WHERE prediction_date >= DATE '2024-01-16'", 'feature')}) WHERE n >= 20),
 d AS (SELECT feature, a.ic AS training_ic, b.ic AS production_ic, {r('a.ic - b.ic')} AS ic_drop,
   CASE WHEN (a.ic > 0.005e0 AND b.ic < -0.005e0) OR (a.ic < -0.005e0 AND b.ic > 0.005e0) THEN 'sign_flip' WHEN abs(a.ic) > 0.005e0 AND abs(b.ic) < 0.005e0 THEN 'decayed' ELSE 'stable' END AS status
   FROM a JOIN b USING (feature))"""


@query("feature_drift", f"WITH {_DRIFT} SELECT * FROM d")
def _(t):
    """The first half of the period stands for training, the second for production."""
    return _drift(t)


_FR = "coalesce(n_drifted * 1e0 / nullif(total_features, 0), 0e0)"


@query("feature_drift_summary", f"""WITH {_DRIFT} SELECT *, {r(_FR, 3)} AS drift_fraction, CASE WHEN {_FR} > 0.2e0 THEN 'retrain_suggested' WHEN n_drifted > 0 THEN 'monitor' ELSE 'stable' END AS recommendation FROM (
 SELECT count(CASE WHEN status <> 'stable' THEN 1 END) AS n_drifted, count(CASE WHEN status = 'stable' THEN 1 END) AS stable_features, count(*) AS total_features FROM d)""")
def _(t):
    return P.drift_summary(_drift(t))


@query("drifted_features_by_drop", f"WITH {_DRIFT} SELECT * FROM d WHERE status <> 'stable' ORDER BY ic_drop DESC, feature")
def _(t):
    return _drift(t).filter("status <> 'stable'").orderBy(F.col("ic_drop").desc(), "feature")


_PU = "(SELECT prediction_date, p_up AS x, actual_5d_return AS y, concat(CAST(year(prediction_date) AS VARCHAR), '-W', lpad(CAST(weekofyear(prediction_date) AS VARCHAR), 2, '0')) AS week, 0 AS g FROM {predictor_outcomes} WHERE p_up IS NOT NULL AND actual_5d_return IS NOT NULL)"
_WEEKLY = f"(SELECT week, {r('ic', 4)} AS ic, n FROM ({spearman_sql(f'SELECT * FROM {_PU}', 'week')}) WHERE n >= 5)"


@query("weekly_rank_ic", f"SELECT * FROM {_WEEKLY}")
def _(t):
    return P.weekly_rank_ic(t.predictor_outcomes)


@query("recent_weeks_rank_ic", f"SELECT * FROM {_WEEKLY} ORDER BY week DESC LIMIT 12")
def _(t):
    return P.last_weeks(P.weekly_rank_ic(t.predictor_outcomes), 12)


@query("predictor_sizing", f"""
WITH w AS (SELECT *, row_number() OVER (ORDER BY week DESC) <= 8 AS rec FROM {_WEEKLY}),
ww AS (SELECT count(CASE WHEN ic > 0 THEN 1 END) AS total_positive_weeks, count(*) AS total_weeks, count(CASE WHEN rec AND ic > 0 THEN 1 END) AS recent_positive_weeks,
   count(CASE WHEN rec THEN 1 END) AS recent_total_weeks, coalesce(avg(CASE WHEN rec THEN ic END), 0e0) AS recent FROM w),
o AS ({spearman_sql(f'SELECT * FROM {_PU}', 'g')}),
p AS (SELECT avg((rank() + (c - 1) / 2e0) / m * y) AS w, avg(y) AS e FROM (SELECT *, rank() OVER (PARTITION BY prediction_date ORDER BY x) AS "rank", count(*) OVER (PARTITION BY prediction_date, x) AS c, count(*) OVER (PARTITION BY prediction_date) AS m FROM {_PU}))
SELECT o.n AS n_samples, {r('o.ic', 4)} AS overall_rank_ic, {r('recent', 4)} AS recent_mean_ic, recent_positive_weeks, recent_total_weeks, total_positive_weeks, total_weeks,
  {r('w - e')} AS sizing_lift, {r('e')} AS equal_weight_return, {r('w')} AS weighted_return,
  CASE WHEN o.ic >= 0.05e0 AND recent >= 0.05e0 AND recent_positive_weeks >= least(6, recent_total_weeks) THEN 'enable' ELSE 'keep_disabled' END AS recommendation FROM o, ww, p""".replace("(rank() + (c - 1)", '("rank" + (c - 1)'))
def _(t):
    return P.predictor_sizing(t.predictor_outcomes)


_SCAN = "(SELECT s.*, u.return_5d, u.beat_spy_5d FROM {scanner_evaluations} s LEFT JOIN {universe_returns} u USING (ticker, eval_date))"
_GATE = " UNION ALL ".join(
    f"SELECT '{g}' AS gate, count(*) AS n_rejected, {_a('beat_spy_5d')} AS leakage_rate, {_a('return_5d')} AS avg_return_5d FROM {_SCAN} WHERE {c} AND beat_spy_5d IS NOT NULL"
    for g, c in (("liquidity_pass", "liquidity_pass = 0"), ("volatility_pass", "volatility_pass = 0"), ("tech_score", "tech_score < 60")))


@query("gate_leakage", _GATE)
def _(t):
    return P.gate_leakage(t.scanner_evaluations, t.universe_returns)


_LEAK = "avg(CASE WHEN quant_filter_pass = 0 THEN beat_spy_5d END)"


@query("scanner_leakage", f"""SELECT (SELECT count(DISTINCT eval_date) FROM {{scanner_evaluations}}) AS n_weeks, count(*) AS n_total_stocks, count(CASE WHEN quant_filter_pass = 1 THEN 1 END) AS n_passed,
  count(CASE WHEN quant_filter_pass = 0 THEN 1 END) AS n_rejected, {r(_LEAK, 4)} AS leakage_rate, 0.15e0 AS leakage_threshold,
  {r('avg(CASE WHEN quant_filter_pass = 1 THEN return_5d END) - avg(return_5d)', 4)} AS filter_lift, {_LEAK} > 0.15e0 AS high_leakage FROM {_SCAN}""")
def _(t):
    return P.scanner_leakage(t.scanner_evaluations, t.universe_returns)


@query("gates_to_relax", f"SELECT gate, leakage_rate AS current_leakage, 'relax' AS action FROM ({_GATE}) WHERE leakage_rate > 0.15e0 AND (SELECT {_LEAK} > 0.15e0 FROM {_SCAN})")
def _(t):
    s, u = t.scanner_evaluations, t.universe_returns
    return P.gates_to_relax(P.gate_leakage(s, u), P.scanner_leakage(s, u))


# --- gates that refuse still answer -----------------------------------------------

NEVER = 1_000_000_000


def gates(name: str, counts: str, metrics: list[str], least: int) -> str:
    """The gate as it is set, and one that no table passes: a row each, from the plain oracle of the result."""
    return " UNION ALL ".join(
        f"SELECT {k} AS least, CASE WHEN g.n >= {k} THEN 'ok' ELSE 'insufficient_data' END AS status, g.n AS n_samples, "
        + ", ".join(f"CASE WHEN g.n >= {k} THEN CAST({m} AS DOUBLE) END AS {m}" for m in metrics)
        + f" FROM ({counts}) g LEFT JOIN ({ORACLES[name]}) ON true" for k in (least, NEVER))


def both(counts, build, metrics, least):
    one = lambda k: with_status(counts, build(k).select(*[F.col(m).cast("double").alias(m) for m in metrics]), k).select(
        F.lit(k).alias("least"), "status", "n_samples", *metrics)
    return one(least).unionByName(one(NEVER))


_HEALTH = ["rolling_ic", "hit_rate", "ic_ratio"]


@query("production_health_gate", gates("production_health", f"SELECT count(*) AS n FROM {recent_sql(120)}", _HEALTH, 10))
def _(t):
    counts = P.recent_resolved(t.predictor_outcomes, ASOF, 120).agg(F.count("*").alias("n"))
    return both(counts, lambda k: P.production_health(t.predictor_outcomes, ASOF, training_ic=0.3, lookback_days=120, min_samples=k), _HEALTH, 10)


_SIZING = ["overall_rank_ic", "recent_mean_ic", "sizing_lift"]


@query("predictor_sizing_gate", gates("predictor_sizing", "SELECT count(*) AS n FROM {predictor_outcomes} WHERE p_up IS NOT NULL AND actual_5d_return IS NOT NULL", _SIZING, 30))
def _(t):
    counts = t.predictor_outcomes.filter("p_up IS NOT NULL AND actual_5d_return IS NOT NULL").agg(F.count("*").alias("n"))
    return both(counts, lambda k: P.predictor_sizing(t.predictor_outcomes, min_samples=k), _SIZING, 30)


_MACRO = ["with_accuracy", "without_accuracy", "accuracy_lift"]


@query("macro_evaluation_gate", gates("macro_evaluation", "SELECT count(*) AS n FROM {cio_evaluations} c JOIN {universe_returns} u ON u.ticker = c.ticker AND u.eval_date = c.eval_date WHERE combined_score IS NOT NULL AND final_score IS NOT NULL AND return_5d IS NOT NULL", _MACRO, 10))
def _(t):
    counts = t.cio_evaluations.filter("combined_score IS NOT NULL AND final_score IS NOT NULL").join(
        t.universe_returns.filter("return_5d IS NOT NULL"), ["ticker", "eval_date"]).agg(F.count("*").alias("n"))
    return both(counts, lambda k: P.macro_evaluation(t.cio_evaluations, t.universe_returns, min_samples=k), _MACRO, 10)
