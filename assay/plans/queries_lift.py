"""Stage lift queries with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.functions.aggregates import binary_counts, binary_metrics
from assay.operators import lift as L
from assay.plans.registry import query
from assay.plans.views import r

UR = "(SELECT * FROM {universe_returns} WHERE return_5d IS NOT NULL)"


def counts(sel: str, out: str) -> str:
    return (f"count(CASE WHEN {out} = 1 AND {sel} THEN 1 END) AS tp, count(CASE WHEN {out} = 0 AND {sel} THEN 1 END) AS fp, "
            f"count(CASE WHEN {out} = 1 AND NOT ({sel}) THEN 1 END) AS fn, count(CASE WHEN {out} = 0 AND NOT ({sel}) THEN 1 END) AS tn")


P, R_ = "(tp * 1e0 / nullif(tp + fp, 0))", "(tp * 1e0 / nullif(tp + fn, 0))"
RATES = (f"{r(P, 4)} AS precision, {r(R_, 4)} AS recall, {r(f'2 * {P} * {R_} / nullif({P} + {R_}, 0)', 4)} AS f1, "
         f"{r('(tp + tn) * 1e0 / nullif(tp + fp + fn + tn, 0)', 4)} AS accuracy, tp, fp, fn, tn, tp + fp + fn + tn AS n")

SCANNER = f"""SELECT {r('a', 4)} AS universe_avg, {r('s', 4)} AS passing_avg, {r('s - a', 4)} AS lift, n_universe, n_passing, {RATES} FROM (
  SELECT avg(return_5d) AS a, avg(CASE WHEN quant_filter_pass = 1 THEN return_5d END) AS s, count(*) AS n_universe,
         count(CASE WHEN quant_filter_pass = 1 THEN 1 END) AS n_passing, {counts('quant_filter_pass = 1', 'beat_spy_5d')}
  FROM {UR} u JOIN {{scanner_evaluations}} USING (ticker, eval_date))"""

TEAM = f"""SELECT team_id, {r('pick', 4)} AS pick_avg, {r('sec', 4)} AS sector_avg, {r('quant', 4)} AS quant_avg, {r('pick - sec', 4)} AS lift,
   {r('pick - quant', 4)} AS lift_vs_quant, n_picks, n_candidates, coalesce(nsec, 0) AS n_sector_universe, {RATES}
 FROM (SELECT team_id, avg(CASE WHEN team_recommended = 1 THEN return_5d END) AS pick, avg(return_5d) AS quant,
         count(CASE WHEN team_recommended = 1 THEN 1 END) AS n_picks, count(*) AS n_candidates, {counts('team_recommended = 1', 'beat_sector_5d')}
       FROM {UR} u JOIN {{team_candidates}} USING (ticker, eval_date) GROUP BY team_id) a
 LEFT JOIN (SELECT p.team_id, avg(u.return_5d) AS sec, count(u.return_5d) AS nsec FROM (
         SELECT DISTINCT team_id, sector FROM {UR} u JOIN {{team_candidates}} USING (ticker, eval_date) WHERE team_recommended = 1) p
       JOIN {UR} u ON u.sector = p.sector GROUP BY 1) b USING (team_id)"""

CIO = f"""SELECT {r('a', 4)} AS all_recs_avg, {r('s', 4)} AS advance_avg, {r('j', 4)} AS reject_avg, {r('s - a', 4)} AS lift, n_recs, n_advance, n_reject, {RATES} FROM (
  SELECT avg(return_5d) AS a, avg(CASE WHEN cio_decision = 'ADVANCE' THEN return_5d END) AS s, avg(CASE WHEN cio_decision = 'REJECT' THEN return_5d END) AS j,
         count(*) AS n_recs, count(CASE WHEN cio_decision = 'ADVANCE' THEN 1 END) AS n_advance, count(CASE WHEN cio_decision = 'REJECT' THEN 1 END) AS n_reject,
         {counts("coalesce(cio_decision = 'ADVANCE', false)", 'beat_spy_5d')}
  FROM {UR} u JOIN {{cio_evaluations}} USING (ticker, eval_date))"""

RANKING = f"""SELECT cio_avg, ranking_avg, avg_overlap, n_dates, n_picks, {r('cio_avg - ranking_avg', 4)} AS lift, {r('cio_avg - ranking_avg', 4)} > 0 AS cio_beats_ranking FROM (
  SELECT {r('avg(ca)', 4)} AS cio_avg, {r('avg(ra)', 4)} AS ranking_avg, {r('avg(ov)', 4)} AS avg_overlap, count(*) AS n_dates, CAST(sum(k) AS BIGINT) AS n_picks FROM (
    SELECT eval_date, max(k) AS k, avg(CASE WHEN adv THEN return_5d END) AS ca, avg(CASE WHEN rn <= k AND final_score IS NOT NULL THEN return_5d END) AS ra,
           count(CASE WHEN adv AND rn <= k AND final_score IS NOT NULL THEN 1 END) AS ov FROM (
      SELECT *, count(CASE WHEN adv THEN 1 END) OVER (PARTITION BY eval_date) AS k, count(final_score) OVER (PARTITION BY eval_date) AS ns,
             row_number() OVER (PARTITION BY eval_date ORDER BY final_score DESC NULLS LAST, ticker) AS rn FROM (
        SELECT u.*, c.final_score, c.cio_decision = 'ADVANCE' AS adv FROM {UR} u JOIN {{cio_evaluations}} c USING (ticker, eval_date)))
    WHERE k > 0 AND ns > 0 GROUP BY eval_date))"""

PREDICTOR = f"""SELECT {r('a', 4)} AS all_avg, {r('s', 4)} AS up_avg, {r('j', 4)} AS down_avg, {r('s - a', 4)} AS lift, n_all, n_up, n_down, {RATES} FROM (
  SELECT avg(return_5d) AS a, avg(CASE WHEN predicted_direction = 'UP' THEN return_5d END) AS s, avg(CASE WHEN predicted_direction = 'DOWN' THEN return_5d END) AS j,
         count(*) AS n_all, count(CASE WHEN predicted_direction = 'UP' THEN 1 END) AS n_up, count(CASE WHEN predicted_direction = 'DOWN' THEN 1 END) AS n_down,
         {counts("predicted_direction = 'UP'", 'beat_spy_5d')}
  FROM {UR} u JOIN {{predictor_outcomes}} p ON u.ticker = p.symbol AND u.eval_date = p.prediction_date)"""

EXECUTOR = f"""SELECT {r('s', 4)} AS traded_avg, {r('a', 4)} AS approved_avg, {r('s - a', 4)} AS lift, n_traded, n_approved, {RATES} FROM (
  SELECT avg(return_5d) AS a, avg(CASE WHEN tr THEN return_5d END) AS s, count(CASE WHEN tr THEN 1 END) AS n_traded, count(*) AS n_approved, {counts('sel', 'beat_spy_5d')}
  FROM (SELECT u.*, true AS tr, true AS sel FROM {UR} u JOIN {{trades}} t ON u.ticker = t.ticker AND u.eval_date = t.date AND t.action = 'ENTER'
        UNION ALL SELECT u.*, false, EXISTS (SELECT 1 FROM {{trades}} t WHERE u.ticker = t.ticker AND u.eval_date = t.date AND t.action = 'ENTER')
        FROM {UR} u JOIN {{shadow_book}} b ON u.ticker = b.ticker AND u.eval_date = b.date))"""

PIPELINE = f"""SELECT {r('u.a', 4)} AS universe_avg, x.t AS traded_avg, {r('x.t - u.a', 4)} AS lift FROM (SELECT avg(return_5d) AS a FROM {UR}) u,
  (SELECT coalesce((SELECT traded_avg FROM ({EXECUTOR})), (SELECT advance_avg FROM ({CIO}))) AS t) x"""


@query("attribution_table", """
SELECT u.ticker, CAST(u.eval_date AS VARCHAR) AS eval_date, u.sector, u.close_price, u.return_5d, u.return_10d, u.spy_return_5d, u.spy_return_10d,
  u.beat_spy_5d, u.beat_spy_10d, u.sector_etf, u.sector_etf_return_5d, u.beat_sector_5d,
  se.tech_score, se.scan_path, se.quant_filter_pass, se.liquidity_pass, se.volatility_pass, se.balance_sheet_pass, se.filter_fail_reason,
  tc.team_id, tc.quant_rank, tc.quant_score AS team_quant_score, tc.qual_score AS team_qual_score, tc.team_recommended,
  ce.combined_score AS cio_combined_score, ce.macro_shift AS cio_macro_shift, ce.final_score AS cio_final_score, ce.cio_decision, ce.cio_conviction, ce.cio_rank,
  po.predicted_direction, po.prediction_confidence, po.p_up, po.p_down, po.actual_5d_return AS predictor_actual_5d,
  t.action, t.fill_price, t.realized_return_pct, t.trigger_type, t.exit_type, b.block_reason, b.intended_position_pct
FROM {universe_returns} u
LEFT JOIN {scanner_evaluations} se ON u.ticker = se.ticker AND u.eval_date = se.eval_date
LEFT JOIN {team_candidates} tc ON u.ticker = tc.ticker AND u.eval_date = tc.eval_date
LEFT JOIN {cio_evaluations} ce ON u.ticker = ce.ticker AND u.eval_date = ce.eval_date
LEFT JOIN {predictor_outcomes} po ON u.ticker = po.symbol AND u.eval_date = po.prediction_date
LEFT JOIN {trades} t ON u.ticker = t.ticker AND u.eval_date = t.date AND t.action = 'ENTER'
LEFT JOIN {shadow_book} b ON u.ticker = b.ticker AND u.eval_date = b.date""")
def _(t):
    return L.attribution_table(t.universe_returns, t.scanner_evaluations, t.team_candidates,
                               t.cio_evaluations, t.predictor_outcomes, t.trades, t.shadow_book)


@query("lift_status", """
SELECT count(DISTINCT eval_date) AS n_dates, count(return_5d) AS n_universe_rows, 'ok' AS status FROM {universe_returns}""")
def _(t):
    return L.universe_status(t.universe_returns)


@query("scanner_lift", SCANNER)
def _(t):
    return L.scanner_lift(t.universe_returns, t.scanner_evaluations)


@query("team_lift", TEAM)
def _(t):
    return L.team_lift(t.universe_returns, t.team_candidates)


@query("committee_lift", CIO)
def _(t):
    return L.committee_lift(t.universe_returns, t.cio_evaluations)


@query("committee_vs_ranking", RANKING)
def _(t):
    return L.committee_vs_ranking(t.universe_returns, t.cio_evaluations)


@query("predictor_lift", PREDICTOR)
def _(t):
    return L.predictor_lift(t.universe_returns, t.predictor_outcomes)


@query("executor_lift", EXECUTOR)
def _(t):
    return L.executor_lift(t.universe_returns, t.trades, t.shadow_book)


@query("pipeline_lift", PIPELINE)
def _(t):
    ex = L.executor_lift(t.universe_returns, t.trades, t.shadow_book)
    return L.pipeline_lift(t.universe_returns, ex, L.committee_lift(t.universe_returns, t.cio_evaluations))


_NONE = "CAST(NULL AS DOUBLE) AS precision, CAST(NULL AS DOUBLE) AS recall, CAST(NULL AS DOUBLE) AS f1"
SUMMARY = f"""
SELECT 'scanner' AS stage, passing_avg AS mean, universe_avg AS baseline, lift, n_passing AS n_selected, precision, recall, f1 FROM ({SCANNER})
UNION ALL SELECT 'teams', {r('avg(pick_avg)', 4)}, {r('avg(sector_avg)', 4)}, {r('avg(lift)', 4)}, CAST(sum(n_picks) AS BIGINT), {r('avg(precision)', 4)}, {r('avg(recall)', 4)}, {r('avg(f1)', 4)} FROM ({TEAM})
UNION ALL SELECT 'committee', advance_avg, all_recs_avg, lift, n_advance, precision, recall, f1 FROM ({CIO})
UNION ALL SELECT 'committee_vs_ranking', cio_avg, ranking_avg, lift, n_picks, {_NONE} FROM ({RANKING})
UNION ALL SELECT 'predictor', up_avg, all_avg, lift, n_up, precision, recall, f1 FROM ({PREDICTOR})
UNION ALL SELECT 'executor', traded_avg, approved_avg, lift, n_traded, precision, recall, f1 FROM ({EXECUTOR})
UNION ALL SELECT 'pipeline', traded_avg, universe_avg, lift, NULL, {_NONE} FROM ({PIPELINE})"""


@query("stage_lift_summary", SUMMARY)
def _(t):
    return L.lift_summary(t.universe_returns, t.scanner_evaluations, t.team_candidates, t.cio_evaluations,
                          t.predictor_outcomes, t.trades, t.shadow_book)


@query("binary_metrics_by_sector", f"""
SELECT sector, {RATES} FROM (SELECT sector, {counts('quant_filter_pass = 1', 'beat_sector_5d')}
  FROM {{universe_returns}} JOIN {{scanner_evaluations}} USING (ticker, eval_date) GROUP BY sector)""")
def _(t):
    """Classification metrics from two flag columns, per sector."""
    m = t.universe_returns.join(t.scanner_evaluations, ["ticker", "eval_date"])
    flags = binary_counts(F.col("quant_filter_pass") == 1, F.col("beat_sector_5d") == 1)
    return binary_metrics(m.groupBy("sector").agg(*[c.alias(k) for k, c in flags.items()])).select("sector", *L.RATES)
