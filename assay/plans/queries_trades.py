"""Trade queries with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.functions.scalars import (
    ENTRY_TRIGGERS, EXIT_RULES, POST_TRADE_TRIGGERS, keyword_category, time_of_day,
)
from assay.operators import trades as TR
from assay.plans.queries_lift import RATES
from assay.plans.registry import query
from assay.plans.views import r


def category_sql(col: str, words) -> str:
    whens = " ".join(f"WHEN contains(lower({col}), '{w}') THEN '{c}'" for w, c in words)
    return f"CASE WHEN {col} IS NULL OR {col} = '' THEN 'unknown' {whens} ELSE 'other' END"


HOUR = "TRY_CAST(split_part(split_part(fill_time, 'T', CASE WHEN contains(fill_time, 'T') THEN 2 ELSE 1 END), ':', 1) AS INT)"
TIME = f"CASE WHEN {HOUR} IS NULL THEN 'unknown' WHEN {HOUR} < 10 THEN 'early (pre-10)' WHEN {HOUR} < 12 THEN 'morning (10-12)' WHEN {HOUR} < 14 THEN 'midday (12-14)' ELSE 'afternoon (14+)' END"


def mean(c: str) -> str:
    return r(f"avg({c})", 4)


def wins(c: str) -> str:
    return r(f"avg(CASE WHEN {c} > 0 THEN 1e0 WHEN {c} <= 0 THEN 0e0 END)", 4)


TRIPS = """(SELECT e.trade_id AS exit_id, e.entry_trade_id, e.ticker, e.date AS exit_date, e.fill_price AS exit_price, e.trigger_type AS exit_type,
   e.realized_return_pct, e.realized_alpha_pct, e.days_held, en.date AS entry_date, en.fill_price AS entry_price, en.signal_price
 FROM {trades} e JOIN {trades} en ON e.entry_trade_id = en.trade_id
 WHERE e.action IN ('EXIT', 'REDUCE') AND en.action = 'ENTER' AND e.fill_price IS NOT NULL AND en.fill_price IS NOT NULL)"""

_mfe, _mae = "((hi - entry_price) / entry_price * 100)", "((lo - entry_price) / entry_price * 100)"
_real = "coalesce(realized_return_pct, (exit_price - entry_price) / entry_price * 100)"
TIMED = f"""(SELECT exit_id, ticker, entry_date, exit_date, exit_type, entry_price, exit_price, {r(_mfe, 2)} AS mfe_pct, {r(_mae, 2)} AS mae_pct,
   {r(_real, 2)} AS realized_return_pct, {r(f'CASE WHEN {_mfe} > 0.01e0 THEN {_real} / {_mfe} END', 2)} AS capture_ratio, days_held
 FROM (SELECT t.*, b.hi, b.lo FROM {TRIPS} t JOIN (
   SELECT t.exit_id, max(b.high) AS hi, min(b.low) AS lo FROM {TRIPS} t JOIN {{bars}} b ON b.ticker = t.ticker AND b.date BETWEEN t.entry_date AND t.exit_date GROUP BY 1) b
   USING (exit_id) WHERE t.entry_price > 0))"""


@query("round_trips", f"""SELECT exit_id, entry_trade_id, ticker, CAST(exit_date AS VARCHAR) AS exit_date, exit_price, exit_type, realized_return_pct,
 realized_alpha_pct, days_held, CAST(entry_date AS VARCHAR) AS entry_date, entry_price, signal_price FROM {TRIPS}""")
def _(t):
    return TR.round_trips(t.trades)


def timed(t):
    return t.kept("exit_timing", lambda: TR.exit_timing(t.trades, t.bars))


@query("exit_timing_trades", f"SELECT * REPLACE (CAST(entry_date AS VARCHAR) AS entry_date, CAST(exit_date AS VARCHAR) AS exit_date) FROM {TIMED}")
def _(t):
    return timed(t)


@query("exit_timing_summary", f"""SELECT *, CASE WHEN avg_capture_ratio < 0.3e0 THEN 'exits_too_early' WHEN avg_realized_return > avg_mfe * 0.6e0 THEN 'exits_well_timed'
   WHEN avg_capture_ratio > 0.8e0 THEN 'exits_well_timed' ELSE 'exits_could_improve' END AS diagnosis FROM (
 SELECT count(*) AS n_roundtrips, {r('avg(mfe_pct)', 2)} AS avg_mfe, {r('avg(mae_pct)', 2)} AS avg_mae, {r('avg(realized_return_pct)', 2)} AS avg_realized_return,
  {r('avg(capture_ratio)', 2)} AS avg_capture_ratio, {r('median(mfe_pct)', 2)} AS median_mfe, {r('median(mae_pct)', 2)} AS median_mae FROM {TIMED})""")
def _(t):
    return TR.exit_timing_summary(timed(t))


@query("exit_timing_by_type", f"""SELECT exit_type, count(*) AS n, {r('avg(mfe_pct)', 2)} AS avg_mfe, {r('avg(mae_pct)', 2)} AS avg_mae,
  {r('avg(realized_return_pct)', 2)} AS avg_realized, {r('avg(capture_ratio)', 2)} AS avg_capture FROM {TIMED} WHERE exit_type IS NOT NULL GROUP BY 1 HAVING count(*) >= 2""")
def _(t):
    return TR.exit_timing_by_type(timed(t))


_ENT = "(SELECT * FROM {trades} WHERE action = 'ENTER')"
_SCORE = f"""count(*) AS n_trades, {mean('CASE WHEN signal_price > 0 THEN (fill_price - signal_price) / signal_price * 100 END')} AS avg_slippage_vs_signal,
  {mean('CASE WHEN price_at_order > 0 THEN (fill_price - price_at_order) / price_at_order * 100 END')} AS avg_slippage_vs_open, {mean('realized_alpha_pct')} AS avg_realized_alpha,
  {mean('realized_return_pct')} AS avg_realized_return, {mean('days_held')} AS avg_days_held, {wins('realized_alpha_pct')} AS win_rate_vs_spy,
  count(CASE WHEN realized_alpha_pct > 0 THEN 1 END) AS tp, count(CASE WHEN realized_alpha_pct <= 0 THEN 1 END) AS fp,
  {r('count(CASE WHEN realized_alpha_pct > 0 THEN 1 END) * 1e0 / nullif(count(realized_alpha_pct), 0)', 4)} AS precision"""


@query("trigger_scorecard", f"""SELECT {category_sql('trigger_type', ENTRY_TRIGGERS)} AS trigger, {_SCORE} FROM {_ENT} GROUP BY 1 HAVING count(*) >= 3
UNION ALL SELECT '(all)', {_SCORE} FROM {_ENT}""")
def _(t):
    return TR.trigger_scorecard(t.trades)


BY_TRIGGER = f"""SELECT {category_sql('trigger_type', POST_TRADE_TRIGGERS)} AS trigger, count(*) AS n_trades, {mean('realized_alpha_pct')} AS avg_alpha_pct,
  {mean('slippage_vs_signal')} AS avg_slippage_pct, {mean('days_held')} AS avg_days_held, {wins('realized_alpha_pct')} AS win_rate_vs_spy FROM {_ENT} GROUP BY 1 HAVING count(*) >= 3"""
BY_EXIT = f"""SELECT {category_sql('exit_reason', EXIT_RULES)} AS exit_rule, count(*) AS n_trades, {mean('realized_alpha_pct')} AS avg_alpha_pct,
  {mean('realized_return_pct')} AS avg_return_pct, {mean('days_held')} AS avg_days_held, {wins('realized_alpha_pct')} AS win_rate_vs_spy
  FROM {{trades}} WHERE action IN ('EXIT', 'REDUCE') AND entry_trade_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 3"""


@query("post_trade_by_trigger", BY_TRIGGER)
def _(t):
    return TR.post_trade_by_trigger(t.trades)


@query("post_trade_by_exit_rule", BY_EXIT)
def _(t):
    return TR.post_trade_by_exit(t.trades)


@query("post_trade_by_holding_period", f"""SELECT CASE WHEN days_held > 0 AND days_held <= 2 THEN '1-2d' WHEN days_held > 2 AND days_held <= 5 THEN '3-5d' WHEN days_held > 5 AND days_held <= 10 THEN '6-10d'
   WHEN days_held > 10 AND days_held <= 20 THEN '11-20d' WHEN days_held > 20 AND days_held <= 999 THEN '21+d' END AS bucket, count(*) AS n_trades, {mean('realized_alpha_pct')} AS avg_alpha_pct,
   {mean('realized_return_pct')} AS avg_return_pct, {wins('realized_alpha_pct')} AS win_rate_vs_spy
 FROM {_ENT} WHERE realized_alpha_pct IS NOT NULL AND days_held > 0 AND days_held <= 999 GROUP BY 1""")
def _(t):
    return TR.post_trade_by_holding(t.trades)


@query("slippage_by_time_of_day", f"""SELECT {TIME} AS time_bucket, count(*) AS n_trades, {mean('slippage_vs_signal')} AS avg_slippage_pct, {mean('realized_alpha_pct')} AS avg_alpha_pct
 FROM {_ENT} WHERE fill_time IS NOT NULL AND {HOUR} IS NOT NULL GROUP BY 1""")
def _(t):
    return TR.slippage_by_time_of_day(t.trades)


@query("post_trade_summary", f"""SELECT a.*, b.trigger AS best_trigger, c.exit_rule AS best_exit_rule FROM (
 SELECT count(CASE WHEN action = 'ENTER' THEN 1 END) AS n_entries, count(CASE WHEN action IN ('EXIT', 'REDUCE') AND entry_trade_id IS NOT NULL THEN 1 END) AS n_exits,
  count(CASE WHEN action = 'ENTER' THEN realized_alpha_pct END) AS n_roundtrips, {mean("CASE WHEN action = 'ENTER' THEN realized_alpha_pct END")} AS avg_alpha_pct,
  {mean("CASE WHEN action = 'ENTER' THEN slippage_vs_signal END")} AS avg_slippage_pct, {mean("CASE WHEN action = 'ENTER' THEN days_held END")} AS avg_days_held,
  {wins("CASE WHEN action = 'ENTER' THEN realized_alpha_pct END")} AS win_rate_vs_spy FROM {{trades}}) a,
 (SELECT trigger FROM ({BY_TRIGGER}) WHERE avg_alpha_pct IS NOT NULL ORDER BY avg_alpha_pct DESC, trigger LIMIT 1) b,
 (SELECT exit_rule FROM ({BY_EXIT}) WHERE avg_alpha_pct IS NOT NULL ORDER BY avg_alpha_pct DESC, exit_rule LIMIT 1) c""")
def _(t):
    return TR.post_trade_summary(t.trades)


@query("trade_text_categories", f"""SELECT {category_sql('trigger_type', ENTRY_TRIGGERS)} AS trigger, {category_sql('exit_reason', EXIT_RULES)} AS exit_rule,
  CASE WHEN fill_time IS NULL THEN NULL ELSE {TIME} END AS time_bucket, action, count(*) AS n FROM {{trades}} GROUP BY 1, 2, 3, 4""")
def _(t):
    """Free-text fields mapped to categories, counted."""
    return t.trades.groupBy(
        keyword_category("trigger_type", ENTRY_TRIGGERS).alias("trigger"),
        keyword_category("exit_reason", EXIT_RULES).alias("exit_rule"),
        F.when(F.col("fill_time").isNotNull(), time_of_day("fill_time")).alias("time_bucket"), "action",
    ).agg(F.count("*").alias("n"))


_FWD = "(SELECT ticker, eval_date AS date, return_5d, beat_spy_5d FROM {universe_returns} WHERE return_5d IS NOT NULL)"


@query("blocked_vs_traded", f"""SELECT * EXCLUDE (tp, fp, fn, tn), {RATES}, {r('coalesce(traded_avg_return_5d, traded_avg_alpha) - blocked_avg_return_5d', 4)} AS guard_lift,
  CASE WHEN coalesce(traded_avg_return_5d, traded_avg_alpha) - blocked_avg_return_5d IS NULL THEN 'insufficient_return_data'
       WHEN {r('coalesce(traded_avg_return_5d, traded_avg_alpha) - blocked_avg_return_5d', 4)} > 0.5e0 THEN 'appropriate'
       WHEN {r('coalesce(traded_avg_return_5d, traded_avg_alpha) - blocked_avg_return_5d', 4)} < -0.5e0 THEN 'too_tight' ELSE 'neutral' END AS assessment
FROM (SELECT count(CASE WHEN b THEN 1 END) AS n_blocked, count(CASE WHEN NOT b THEN 1 END) AS n_traded, {mean('CASE WHEN b THEN return_5d END')} AS blocked_avg_return_5d,
  {mean('CASE WHEN b THEN beat_spy_5d END')} AS blocked_beat_spy_pct, count(CASE WHEN b THEN return_5d END) AS blocked_with_returns, {mean('CASE WHEN NOT b THEN return_5d END')} AS traded_avg_return_5d,
  {mean('CASE WHEN NOT b THEN beat_spy_5d END')} AS traded_beat_spy_pct, count(CASE WHEN NOT b THEN return_5d END) AS traded_with_returns, {mean('CASE WHEN NOT b THEN al END')} AS traded_avg_alpha,
  count(CASE WHEN b AND beat_spy_5d = 0 THEN 1 END) AS tp, count(CASE WHEN b AND beat_spy_5d = 1 THEN 1 END) AS fp, count(CASE WHEN NOT b AND beat_spy_5d = 0 THEN 1 END) AS fn, count(CASE WHEN NOT b AND beat_spy_5d = 1 THEN 1 END) AS tn
 FROM (SELECT ticker, date, CAST(NULL AS DOUBLE) AS al, true AS b FROM {{shadow_book}} UNION ALL SELECT ticker, date, realized_alpha_pct, false FROM {_ENT}) x LEFT JOIN {_FWD} f USING (ticker, date))""")
def _(t):
    return TR.blocked_vs_traded(t.shadow_book, t.trades, t.universe_returns)


@query("block_reasons", f"""SELECT block_reason, count(*) AS count, {r('avg(research_score)', 2)} AS avg_score, {mean('return_5d')} AS avg_return_5d, count(return_5d) AS n_with_returns,
  {r('count(*) * 1e0 / sum(count(*)) OVER ()', 4)} AS pct_of_blocks FROM {{shadow_book}} LEFT JOIN {_FWD} f USING (ticker, date) GROUP BY 1""")
def _(t):
    return TR.block_reasons(t.shadow_book, t.universe_returns)


_VETO = """(SELECT p.*, coalesce(s.size, 50000e0) AS pos, coalesce(s.size, 50000e0) * actual_5d_return / 100 AS imp FROM {predictor_outcomes} p LEFT JOIN (
  SELECT ticker, date, max(intended_dollars) AS size FROM {shadow_book} WHERE (block_reason LIKE '%veto%' OR predicted_direction = 'DOWN') AND intended_dollars <> 0 GROUP BY 1, 2) s
  ON p.symbol = s.ticker AND p.prediction_date = s.date WHERE predicted_direction = 'DOWN' AND actual_5d_return IS NOT NULL)"""
_AV = "coalesce(sum(CASE WHEN actual_5d_return < 0 THEN abs(imp) END), 0e0)"
_FG = "coalesce(sum(CASE WHEN actual_5d_return >= 0 THEN imp END), 0e0)"
_NC = "count(CASE WHEN actual_5d_return < 0 THEN 1 END)"


@query("veto_value", f"""SELECT count(*) AS n_vetoes, {_NC} AS n_correct, count(*) - {_NC} AS n_incorrect, {r(f'{_NC} * 1e0 / count(*)', 4)} AS precision,
  {r(_AV, 2)} AS total_losses_avoided, {r(_FG, 2)} AS total_alpha_foregone, {r(f'{r(_AV, 4)} - {r(_FG, 4)}', 2)} AS net_veto_value, {r(f'{_AV} / nullif({_NC}, 0)', 2)} AS avg_loss_avoided,
  {r(f'{_FG} / nullif(count(*) - {_NC}, 0)', 2)} AS avg_alpha_foregone, {mean('actual_5d_return')} AS avg_veto_alpha_pct FROM {_VETO}""")
def _(t):
    return TR.veto_value(t.predictor_outcomes, t.shadow_book)


@query("veto_value_by_confidence", f"""SELECT CASE WHEN c <= 0.55e0 THEN '50-55%' WHEN c <= 0.65e0 THEN '55-65%' WHEN c <= 0.75e0 THEN '65-75%' ELSE '75%+' END AS confidence_range,
  count(*) AS n_vetoes, {r(f'{_NC} * 1e0 / count(*)', 4)} AS precision, {r(_AV, 2)} AS losses_avoided, {r(_FG, 2)} AS alpha_foregone, {r(f'{r(_AV, 4)} - {r(_FG, 4)}', 2)} AS net_value
  FROM (SELECT *, coalesce(prediction_confidence, 0.5e0) AS c FROM {_VETO}) GROUP BY 1""")
def _(t):
    return TR.veto_value_by_confidence(t.predictor_outcomes, t.shadow_book)
