"""Domain tables derived from the star-schema test tables.

The text of each view is standard SQL that both Spark and the oracle accept,
so that the two sides start from the same rows.  ``{name}`` stands for another
view or a base table.  Values are rounded where they are later compared with
one another, so the order of a distributed sum cannot flip a flag.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BASE = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def r(expr: str, digits: int = 6) -> str:
    """SQL twin of ``scalars.rnd``."""
    scale = f"{10**digits}e0"
    return f"(floor(({expr}) * {scale} + 0.5000001e0) / {scale})"


def ymd(d: str) -> str:
    return f"(year({d}) * 10000 + month({d}) * 100 + day({d}))"


VIEWS: dict[str, str] = {}

# One row per shipped line: a scored signal with three outcome horizons.
VIEWS["scored_signals"] = f"""
SELECT l.symbol, l.score_date, l.score, l.quant_score, l.qual_score, l.conviction,
       n.region AS sector,
       l.p_up, l.p_down,
       CASE WHEN l.k7 = 0 THEN NULL ELSE l.r5 END AS return_5d,
       CASE WHEN l.k7 = 0 THEN NULL ELSE l.s5 END AS spy_5d_return,
       CASE WHEN l.k7 = 0 THEN NULL WHEN l.r5 > l.s5 THEN 1 ELSE 0 END AS beat_spy_5d,
       CASE WHEN l.k7 <= 1 THEN NULL ELSE l.r10 END AS return_10d,
       CASE WHEN l.k7 <= 1 THEN NULL ELSE l.s10 END AS spy_10d_return,
       CASE WHEN l.k7 <= 1 THEN NULL WHEN l.r10 > l.s10 THEN 1 ELSE 0 END AS beat_spy_10d,
       CASE WHEN l.k7 <= 2 THEN NULL ELSE l.r30 END AS return_30d,
       CASE WHEN l.k7 <= 2 THEN NULL ELSE l.s30 END AS spy_30d_return,
       CASE WHEN l.k7 <= 2 THEN NULL WHEN l.r30 > l.s30 THEN 1 ELSE 0 END AS beat_spy_30d,
       CASE WHEN l.k7 = 0 THEN NULL WHEN l.r5 > 0 THEN 1 ELSE 0 END AS correct_5d
FROM (
  SELECT l_suppkey, concat('S', CAST(l_suppkey AS VARCHAR(20))) AS symbol,
         CAST(l_shipdate AS DATE) AS score_date,
         50 + l_quantity AS score,
         {r('40 + l_extendedprice / 2000e0', 2)} AS quant_score,
         CAST(50 + l_partkey % 47 AS DOUBLE) AS qual_score,
         CASE l_returnflag WHEN 'A' THEN 'rising' WHEN 'N' THEN 'stable' ELSE 'declining' END AS conviction,
         CASE WHEN l_linestatus = 'O' THEN CAST({r('0.3e0 + l_discount * 5', 4)} AS VARCHAR(20)) ELSE 'n/a' END AS p_up,
         {r('0.2e0 + l_tax * 4', 4)} AS p_down,
         l_orderkey % 7 AS k7,
         {r('(l_discount - 0.05e0) * 60', 4)} AS r5,
         {r('(dayofyear(l_shipdate) % 5 - 2) * 0.31e0', 4)} AS s5,
         {r('(l_tax - 0.04e0) * 100 + (l_quantity - 25) / 20e0', 4)} AS r10,
         {r('(dayofyear(l_shipdate) % 7 - 3) * 0.37e0', 4)} AS s10,
         {r('(l_extendedprice / l_quantity) % 21 - 10', 4)} AS r30,
         {r('(dayofyear(l_shipdate) % 9 - 4) * 0.43e0', 4)} AS s30
  FROM {{lineitem}}
) l JOIN (
  SELECT s_suppkey, r_name AS region FROM {{supplier}}
  JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
) n ON l.l_suppkey = n.s_suppkey
"""

VIEWS["macro_snapshots"] = """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
       CASE month(o_orderdate) % 4 WHEN 0 THEN 'bull' WHEN 1 THEN 'neutral' WHEN 2 THEN 'bear' ELSE 'caution' END AS market_regime
FROM {orders} WHERE day(o_orderdate) <> 13
"""

# One row per (ticker, date): base of every other supplier-side table.
VIEWS["cells"] = f"""
SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS date,
       count(*) AS n, max(l_linenumber) AS line, max(l_orderkey) AS okey, max(l_partkey) AS pkey,
       max(l_quantity) AS qmax, min(l_quantity) AS qmin,
       {r('avg(100 + l_extendedprice / 5000e0)', 4)} AS px,
       {r('max(100 + l_extendedprice / 5000e0)', 4)} AS px_hi,
       {r('min(100 + l_extendedprice / 5000e0)', 4)} AS px_lo,
       {r('avg(l_discount)', 4)} AS disc, {r('avg(l_tax)', 4)} AS tax,
       max(l_returnflag) AS flag
FROM {{lineitem}} GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
"""

_T = "concat('S', CAST(c.k AS VARCHAR(20)))"
# The committee's total on a cell: from 75 on it is advanced and traded, from 68 on it stays on the watch list.
_TOTAL = "(30 + c.qmax + c.disc * 60 + c.pkey % 9 - 4 + c.pkey % 13 - 6)"

VIEWS["bars"] = f"""
SELECT {_T} AS ticker, c.date,
       {r('c.px - 0.5e0', 4)} AS open, {r('c.px_hi + 1', 4)} AS high, {r('c.px_lo - 1', 4)} AS low,
       c.px AS close, CAST(c.n * 100 AS DOUBLE) AS volume
FROM {{cells}} c
"""

VIEWS["universe_returns"] = f"""
SELECT u.ticker, u.eval_date, u.sector, u.close_price, u.return_5d, u.return_10d,
       u.spy AS spy_return_5d, u.spy10 AS spy_return_10d,
       CASE WHEN u.return_5d IS NULL THEN NULL WHEN u.return_5d > u.spy THEN 1 ELSE 0 END AS beat_spy_5d,
       CASE WHEN u.return_10d IS NULL THEN NULL WHEN u.return_10d > u.spy10 THEN 1 ELSE 0 END AS beat_spy_10d,
       u.sector_etf, u.etf AS sector_etf_return_5d,
       CASE WHEN u.return_5d IS NULL THEN NULL WHEN u.return_5d > u.etf THEN 1 ELSE 0 END AS beat_sector_5d
FROM (
  SELECT {_T} AS ticker, c.date AS eval_date, d.region AS sector, c.px AS close_price,
         CASE WHEN c.okey % 11 = 0 THEN NULL ELSE {r('(c.disc - 0.05e0) * 60 + (c.qmax - 25) / 50e0', 4)} END AS return_5d,
         CASE WHEN c.okey % 11 <= 1 THEN NULL ELSE {r('(c.tax - 0.04e0) * 80', 4)} END AS return_10d,
         {r('(dayofyear(c.date) % 5 - 2) * 0.31e0', 4)} AS spy, {r('(dayofyear(c.date) % 7 - 3) * 0.37e0', 4)} AS spy10,
         concat('X', CAST(d.rk AS VARCHAR(20))) AS sector_etf,
         {r('(dayofyear(c.date) % 6 - 2) * 0.23e0 + d.rk * 0.1e0', 4)} AS etf
  FROM {{cells}} c JOIN (
    SELECT s_suppkey, r_name AS region, r_regionkey AS rk FROM {{supplier}}
    JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
  ) d ON c.k = d.s_suppkey
) u
"""

VIEWS["scanner_evaluations"] = f"""
SELECT {_T} AS ticker, c.date AS eval_date, {r('35 + c.qmax', 4)} AS tech_score,
       CASE WHEN c.flag = 'R' THEN 'momentum' ELSE 'deep_value' END AS scan_path,
       CASE WHEN c.qmax >= 25 AND c.pkey % 5 <> 0 THEN 1 ELSE 0 END AS quant_filter_pass,
       CASE WHEN c.pkey % 5 = 0 THEN 0 ELSE 1 END AS liquidity_pass,
       CASE WHEN c.okey % 6 = 0 THEN 0 ELSE 1 END AS volatility_pass,
       CASE WHEN c.okey % 8 = 0 THEN NULL ELSE 1 END AS balance_sheet_pass,
       CASE WHEN c.qmax < 25 THEN 'tech_score' WHEN c.pkey % 5 = 0 THEN 'liquidity' ELSE NULL END AS filter_fail_reason
FROM {{cells}} c WHERE c.line >= 2
"""

VIEWS["team_candidates"] = f"""
SELECT {_T} AS ticker, c.date AS eval_date, concat('team_', CAST(c.k % 6 AS VARCHAR(20))) AS team_id,
       CAST(1 + c.pkey % 10 AS INT) AS quant_rank, {r('40 + c.qmax', 4)} AS quant_score,
       {r('50 + c.tax * 400', 4)} AS qual_score,
       CASE WHEN c.qmax >= 30 THEN 1 ELSE 0 END AS team_recommended
FROM {{cells}} c WHERE c.line >= 3
"""

VIEWS["cio_evaluations"] = f"""
SELECT z.ticker, z.eval_date, z.combined_score, z.macro_shift,
       {r('z.combined_score + z.macro_shift', 4)} AS final_score,
       CASE WHEN z.combined_score + z.macro_shift + z.noise >= 75 THEN 'ADVANCE'
            WHEN z.noise < 0 THEN 'REJECT' ELSE 'WATCH' END AS cio_decision,
       CASE WHEN z.noise > 3 THEN 'rising' WHEN z.noise < -3 THEN 'declining' ELSE 'stable' END AS cio_conviction,
       CAST(1 + z.pkey % 20 AS INT) AS cio_rank
FROM (
  SELECT {_T} AS ticker, c.date AS eval_date, c.pkey,
         CASE WHEN c.okey % 29 = 0 THEN NULL ELSE {r('30 + c.qmax + c.disc * 60', 4)} END AS combined_score,
         CASE WHEN c.okey % 13 = 0 THEN NULL ELSE CAST(c.pkey % 9 - 4 AS DOUBLE) END AS macro_shift,
         c.pkey % 13 - 6 AS noise
  FROM {{cells}} c WHERE c.line >= 5
) z
"""

# One prediction per (symbol, date): the order with the largest key wins.
VIEWS["predictor_outcomes"] = f"""
SELECT g.okey AS id, concat('S', CAST(g.k AS VARCHAR(20))) AS symbol, g.prediction_date,
       g.direction AS predicted_direction, g.conf AS prediction_confidence,
       CASE WHEN g.okey % 17 = 0 THEN NULL WHEN g.direction = 'UP' THEN g.conf ELSE {r('(1 - g.conf) * 0.6e0', 4)} END AS p_up,
       CASE WHEN g.direction = 'DOWN' THEN g.conf ELSE {r('(1 - g.conf) * 0.4e0', 4)} END AS p_down,
       g.actual AS actual_5d_return,
       CASE WHEN g.actual IS NULL THEN NULL
            WHEN g.direction = 'UP' AND g.actual > 0 THEN 1
            WHEN g.direction = 'DOWN' AND g.actual < 0 THEN 1
            WHEN g.direction = 'FLAT' AND g.actual BETWEEN -1 AND 1 THEN 1 ELSE 0 END AS correct_5d
FROM (
  SELECT m.k, m.prediction_date, m.okey,
         CASE m.st WHEN 'F' THEN 'UP' WHEN 'O' THEN 'DOWN' ELSE 'FLAT' END AS direction,
         {r('0.5e0 + (m.price % 5000) / 10000e0', 4)} AS conf,
         CASE WHEN m.okey % 9 = 0 THEN NULL
              ELSE {r("((m.okey * 37) % 200) / 20e0 - 5 + (m.price % 5000) / 2500e0 * CASE m.st WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE 0 END", 4)} END AS actual
  FROM (
    SELECT CAST(floor(o_custkey / 15e0) AS BIGINT) AS k, CAST(o_orderdate AS DATE) AS prediction_date,
           max(o_orderkey) AS okey, max_by(o_orderstatus, o_orderkey) AS st, max_by(o_totalprice, o_orderkey) AS price
    FROM {{orders}} GROUP BY CAST(floor(o_custkey / 15e0) AS BIGINT), CAST(o_orderdate AS DATE)
  ) m
) g
"""

# Entries and the linked exits; an exit comes three bars after its entry.
VIEWS["trades"] = f"""
SELECT t.trade_id, CAST(NULL AS BIGINT) AS entry_trade_id, t.date, t.date AS signal_trading_day, t.ticker, 'ENTER' AS action,
       t.shares, t.fill AS fill_price, t.px AS price_at_order, t.signal_price, t.trigger_price, t.trigger_type,
       CAST(NULL AS VARCHAR(20)) AS exit_reason, CAST(NULL AS VARCHAR(20)) AS exit_type, t.fill_time,
       t.ret AS realized_return_pct, t.alpha AS realized_alpha_pct, t.spy AS spy_return_during_hold,
       {r('(t.fill - t.signal_price) / t.signal_price * 100', 4)} AS slippage_vs_signal,
       t.held AS days_held, t.position_pct, t.research_score, t.confidence AS prediction_confidence, t.direction AS predicted_direction
FROM {{round_trips}} t
UNION ALL
SELECT t.trade_id + 50000000, t.trade_id, t.exit_date, t.date, t.ticker,
       CASE WHEN t.pkey % 10 = 0 THEN 'REDUCE' ELSE 'EXIT' END,
       CASE WHEN t.pkey % 10 = 0 THEN CAST(floor(t.shares / 2e0) AS INT) ELSE t.shares END, t.exit_fill, t.exit_fill, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
       t.exit_trigger, t.exit_reason, t.exit_trigger, t.fill_time,
       CASE WHEN t.pkey % 4 = 0 THEN NULL ELSE t.ret END, t.alpha, t.spy, CAST(NULL AS DOUBLE), t.held, t.position_pct, t.research_score, t.confidence, t.direction
FROM {{round_trips}} t WHERE t.exit_date IS NOT NULL
"""

VIEWS["round_trips"] = f"""
SELECT e.k * 100000000 + {ymd('e.date')} AS trade_id, e.ticker, e.date, e.exit_date, e.pkey,
       CAST(10 + e.pkey % 90 AS INT) AS shares, e.fill, e.px,
       CASE WHEN e.pkey % 12 = 0 THEN NULL ELSE {r('e.px * (1 + (e.okey % 7 - 3) / 1000e0)', 4)} END AS signal_price,
       {r('e.px * 0.999e0', 4)} AS trigger_price,
       CASE e.pkey % 7 WHEN 0 THEN 'Pullback to average' WHEN 1 THEN 'vwap cross' WHEN 2 THEN 'Support bounce'
            WHEN 3 THEN 'time_expiry' WHEN 4 THEN 'late expiry' WHEN 5 THEN '' ELSE 'gap fill' END AS trigger_type,
       CASE WHEN e.pkey % 9 = 0 THEN NULL
            WHEN e.okey % 2 = 0 THEN concat(concat('2024-01-02T', CAST(9 + e.pkey % 8 AS VARCHAR(20))), ':31:00')
            WHEN e.okey % 5 = 1 THEN 'open'
            ELSE concat(CAST(9 + e.pkey % 8 AS VARCHAR(20)), ':05:00') END AS fill_time,
       e.exit_px AS exit_fill,
       CASE e.okey % 6 WHEN 0 THEN 'trailing_stop hit' WHEN 1 THEN 'Profit_take 20' WHEN 2 THEN 'time_decay'
            WHEN 3 THEN 'momentum fade' WHEN 4 THEN 'manual' ELSE NULL END AS exit_reason,
       CASE e.okey % 3 WHEN 0 THEN 'stop' WHEN 1 THEN 'target' ELSE NULL END AS exit_trigger,
       CASE WHEN e.exit_px IS NULL THEN NULL ELSE {r('(e.exit_px - e.fill) / e.fill * 100', 4)} END AS ret,
       CASE WHEN e.exit_px IS NULL THEN NULL ELSE {r('(e.exit_px - e.fill) / e.fill * 100 - (dayofyear(e.date) % 5 - 2) * 0.31e0', 4)} END AS alpha,
       {r('(dayofyear(e.date) % 5 - 2) * 0.31e0', 4)} AS spy,
       CASE WHEN e.exit_px IS NULL THEN NULL ELSE CAST(e.okey % 26 AS INT) END AS held,
       {r('0.02e0 + (e.pkey % 9) / 100e0', 4)} AS position_pct, {r('50 + e.qmax', 4)} AS research_score,
       {r('0.5e0 + (e.okey % 50) / 100e0', 4)} AS confidence,
       CASE e.okey % 4 WHEN 0 THEN 'DOWN' WHEN 1 THEN 'FLAT' ELSE 'UP' END AS direction
FROM (
  SELECT c.k, {_T} AS ticker, c.date, {_TOTAL} AS total, c.px, {r('c.px * (1 + (c.pkey % 11 - 5) / 1000e0)', 4)} AS fill, c.okey, c.pkey, c.qmax,
         lead(c.date, 3) OVER (PARTITION BY c.k ORDER BY c.date) AS exit_date,
         lead(c.px, 3) OVER (PARTITION BY c.k ORDER BY c.date) AS exit_px
  FROM {{cells}} c
) e WHERE e.total >= 75
"""

VIEWS["shadow_book"] = f"""
SELECT {_T} AS ticker, c.date,
       CASE c.pkey % 5 WHEN 0 THEN 'gbm_veto' WHEN 1 THEN 'sector_cap' WHEN 2 THEN 'score_below_min' WHEN 3 THEN 'correlation' ELSE 'veto_low_conf' END AS block_reason,
       CASE WHEN c.okey % 10 = 0 THEN NULL ELSE {r('45 + c.qmax', 4)} END AS research_score,
       {r('0.5e0 + (c.okey % 50) / 100e0', 4)} AS prediction_confidence,
       CASE c.okey % 3 WHEN 0 THEN 'DOWN' WHEN 1 THEN 'FLAT' ELSE 'UP' END AS predicted_direction,
       {r('0.02e0 + (c.pkey % 9) / 100e0', 4)} AS intended_position_pct,
       CASE WHEN c.pkey % 6 = 0 THEN NULL WHEN c.pkey % 6 = 1 THEN 0e0 ELSE CAST(1000 * (c.pkey % 60) AS DOUBLE) END AS intended_dollars,
       c.px AS current_price, 'neutral' AS market_regime
FROM {{cells}} c WHERE {_TOTAL} >= 68 AND {_TOTAL} < 75
"""

# --- event-log side: 30 dense days with real gaps ---------------------------

VIEWS["event_bars"] = f"""
SELECT concat('U', CAST(user_id AS VARCHAR(20))) AS ticker, CAST(ts AS DATE) AS date,
       min_by(value, event_id) AS open, max(value) AS high, min(value) AS low, max_by(value, event_id) AS close,
       CAST(count(*) AS DOUBLE) AS volume, {r('avg(value) - 25', 4)} AS vwap
FROM {{events}} GROUP BY concat('U', CAST(user_id AS VARCHAR(20))), CAST(ts AS DATE)
"""

VIEWS["features"] = f"""
SELECT concat('U', CAST(user_id AS VARCHAR(20))) AS ticker, CAST(ts AS DATE) AS date,
       min_by(value, event_id) AS open, max(value) AS high, min(value) AS low, max_by(value, event_id) AS close,
       CAST(count(*) AS DOUBLE) AS volume, {r('avg(value) - 25', 4)} AS vwap,
       CASE WHEN max(event_id) % 5 = 0 THEN NULL ELSE {r('(max(value) - min(value)) / 1000e0', 6)} END AS atr_14_pct,
       {r('20 + avg(value) % 60', 4)} AS rsi_14,
       CASE WHEN max(event_id) % 4 = 0 THEN NULL ELSE {r('avg(value) % 17 - 8', 4)} END AS momentum_20d,
       {r('max(value) - avg(value)', 4)} AS upside_gap,
       CAST(max(event_id) % 10 AS DOUBLE) AS breadth,
       CAST(max(event_id) AS BIGINT) AS last_id
FROM {{events}} GROUP BY concat('U', CAST(user_id AS VARCHAR(20))), CAST(ts AS DATE)
"""

VIEWS["event_outcomes"] = f"""
SELECT max(event_id) AS id, concat('U', CAST(user_id AS VARCHAR(20))) AS symbol, CAST(ts AS DATE) AS prediction_date,
       CASE WHEN max(event_id) % 8 = 0 THEN NULL ELSE {r('(avg(value) % 23) - 11 + max(value) / 40e0', 4)} END AS actual_5d_return
FROM {{events}} WHERE event_type IN ('purchase', 'view')
GROUP BY concat('U', CAST(user_id AS VARCHAR(20))), CAST(ts AS DATE)
"""

# --- long price histories per brand ------------------------------------------

VIEWS["brand_bars"] = f"""
SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS date,
       {r('100 + avg(l_extendedprice / l_quantity) / 100e0', 4)} AS close,
       {r('101 + max(l_extendedprice / l_quantity) / 100e0', 4)} AS high,
       max(l_orderkey) AS okey,
       {r('(avg(l_discount) - 0.05e0) * 2 + (avg(l_tax) - 0.04e0)', 6)} AS alpha
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey
GROUP BY p_brand, CAST(l_shipdate AS DATE)
"""

# Predicted alpha, a technical score to rank by, and what the next bar brought to a book that puts a 200th into each.
VIEWS["brand_signals"] = f"""
SELECT ticker, date, alpha, {r('(high - close) / close * 100', 6)} AS score,
       {r('lead(close) OVER (PARTITION BY ticker ORDER BY date) / close / 200 - 0.005e0', 8)} AS fwd FROM {{brand_bars}}
"""

# --- nested JSON documents, one per order ------------------------------------

VIEWS["signal_docs"] = """
SELECT o_orderkey AS doc_id, CAST(o_orderdate AS DATE) AS doc_date,
       concat('signals/', CASE WHEN o_orderkey % 23 = 0 THEN 'latest' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(20)) END, '/signals.json') AS path,
       CASE WHEN o_orderkey % 19 = 0 THEN '{"date": "broken"}'
       ELSE concat('{"date": "', CAST(CAST(o_orderdate AS DATE) AS VARCHAR(20)), '"',
         CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE concat(', "market_regime": "', CASE month(o_orderdate) % 4 WHEN 0 THEN 'bull' WHEN 1 THEN 'neutral' WHEN 2 THEN 'bear' ELSE 'caution' END, '"') END,
         ', "sector_ratings": {"Sec', CAST(o_custkey % 5 AS VARCHAR(20)), '": {"rating": "', CASE o_custkey % 3 WHEN 0 THEN 'overweight' WHEN 1 THEN 'market_weight' ELSE 'underweight' END, '", "modifier": 1.0}}',
         CASE WHEN o_orderkey % 2 = 0 THEN concat(', "signals": {"S', CAST(o_custkey AS VARCHAR(20)), '": {"signal": "', CASE o_custkey % 4 WHEN 0 THEN 'EXIT' WHEN 1 THEN 'HOLD' ELSE 'ENTER' END, '", "score": ', CASE WHEN o_orderkey % 10 = 0 THEN 'null' ELSE CAST(50 + o_orderkey % 50 AS VARCHAR(20)) END, ', "rating": "', CASE WHEN o_custkey % 3 = 0 THEN 'HOLD' ELSE 'BUY' END, '", "sub_scores": {"technical": 50, "news": ', CASE WHEN o_orderkey % 8 = 0 THEN 'null' ELSE CAST(o_orderkey % 91 AS VARCHAR(20)) END, ', "research": ', CAST(o_orderkey % 83 AS VARCHAR(20)), '}}}')
              WHEN o_orderkey % 4 = 1 THEN concat(', "signals": [{"ticker": "S', CAST(o_custkey AS VARCHAR(20)), '", "rating": "BUY", "score": ', CAST(55 + o_orderkey % 45 AS VARCHAR(20)), '}]')
              ELSE '' END,
         ', "universe": [{"ticker": "S', CAST(o_custkey AS VARCHAR(20)), '", "signal": "', CASE o_orderkey % 3 WHEN 0 THEN 'EXIT' WHEN 1 THEN 'HOLD' ELSE 'REDUCE' END, '", "score": ', CAST(40 + o_orderkey % 55 AS VARCHAR(20)), ', "conviction": "stable", "sector": "Sec', CAST(o_custkey % 5 AS VARCHAR(20)), '", "sub_scores": {"quant": ', CAST(o_orderkey % 97 AS VARCHAR(20)), ', "qual": ', CAST(o_orderkey % 89 AS VARCHAR(20)), '}, "short_interest_adj": ', CAST(o_orderkey % 6 AS VARCHAR(20)), '}, ',
         '{"ticker": "s', CAST(o_custkey + 1 AS VARCHAR(20)), '", "signal": "HOLD", "score": ', CAST(30 + o_orderkey % 60 AS VARCHAR(20)), ', "conviction": "declining", "sector": "Sec', CAST((o_custkey + 1) % 5 AS VARCHAR(20)), '", "quant_score": ', CAST(o_orderkey % 79 AS VARCHAR(20)), ', "qual_score": ', CAST(o_orderkey % 73 AS VARCHAR(20)), '}]',
         ', "buy_candidates": [{"ticker": "S', CAST(o_custkey + 1 AS VARCHAR(20)), '", "signal": "ENTER", "score": ', CAST(60 + o_orderkey % 40 AS VARCHAR(20)), ', "conviction": "rising", "sector": "Sec', CAST((o_custkey + 2) % 5 AS VARCHAR(20)), '", "institutional_boost": ', CAST(o_orderkey % 4 AS VARCHAR(20)), '}',
         CASE WHEN o_orderkey % 5 = 0 THEN concat(', {"ticker": "S', CAST(o_custkey AS VARCHAR(20)), '", "signal": "ENTER", "score": 71, "conviction": "rising", "sector": "Sec0"}') ELSE '' END,
         ']}') END AS body
FROM {orders}
"""

VIEWS["prediction_docs"] = f"""
SELECT o_orderkey AS doc_id,
       concat('predictions/', CASE WHEN o_orderkey % 31 = 0 THEN 'latest' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(20)) END, '.json') AS path,
       concat('{{"predictions": [{{"ticker": "S', CAST(o_custkey AS VARCHAR(20)), '", "predicted_direction": "', CASE o_orderstatus WHEN 'F' THEN 'UP' WHEN 'O' THEN 'DOWN' ELSE 'FLAT' END,
              '", "prediction_confidence": 0.', CAST(50 + o_orderkey % 49 AS VARCHAR(20)), ', "p_up": 0.', CAST(10 + o_orderkey % 80 AS VARCHAR(20)), '}}, {{"ticker": ',
              CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE concat('"S', CAST(o_custkey + 1 AS VARCHAR(20)), '"') END, ', "predicted_direction": "DOWN", "p_down": 0.', CAST(10 + o_orderkey % 85 AS VARCHAR(20)), '}}]}}') AS body
FROM {{orders}}
"""
# JSON braces are doubled in the text above only where the view is an f-string.

VIEWS["training_docs"] = f"""
SELECT p_partkey AS version, concat('{{"feature_ics": {{"rsi_14": ', CAST({r('(p_size - 25) / 100e0', 4)} AS VARCHAR(20)), ', "breadth": ', CAST({r('p_size / 500e0', 4)} AS VARCHAR(20)), '}}',
       CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat(', "walk_forward": {{"median_ic": ', CAST({r('p_size / 400e0', 4)} AS VARCHAR(20)), '}}') END,
       CASE WHEN p_partkey % 6 = 0 THEN '' ELSE concat(', "test_ic": ', CAST({r('p_size / 300e0', 4)} AS VARCHAR(20))) END,
       CASE WHEN p_partkey % 4 = 0 THEN ', "noise_candidates": ["breadth", "rsi_14"]' ELSE '' END,
       CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ', "deployed_at": "2024-01-05T00:00:00Z"' END, '}}') AS body
FROM {{part}}
"""

VIEWS["parameter_docs"] = """
SELECT c_custkey AS doc_id, concat('{', CASE WHEN c_custkey % 2 = 0 THEN concat('"tech_score_min": ', CAST(50 + c_custkey % 30 AS VARCHAR(20)), ', ') ELSE '' END,
       CASE WHEN c_custkey % 3 = 0 THEN '"max_atr_pct": 9.5, ' ELSE '' END, '"retired_key": 1, "updated": ', CAST(c_custkey AS VARCHAR(20)), '}') AS body
FROM {customer}
"""

VIEWS["boost_docs"] = """
SELECT c_custkey AS doc_id, concat('{"short_interest_buy_boost": ', CAST(1 + c_custkey % 3 AS VARCHAR(20)), '.5, ',
       CASE WHEN c_custkey % 4 <> 1 THEN concat('"institutional_boost": ', CAST(2 + c_custkey % 5 AS VARCHAR(20)), '.0, ') ELSE '' END,
       '"retired_key": 1, "updated": ', CAST(c_custkey AS VARCHAR(20)), '}') AS body
FROM {customer}
"""

VIEWS["strategy_docs"] = """
SELECT c_custkey AS combo_id, concat('{"atr_multiplier": ', CAST(2 + c_custkey % 3 AS VARCHAR(20)), '.5, "profit_take_pct": 0.2',
       CASE WHEN c_custkey % 3 = 0 THEN ', "strategy": {"profit_take_pct": 0.33, "time_decay_exit_days": 21}' WHEN c_custkey % 3 = 1 THEN ', "strategy": {}' ELSE '' END, '}') AS body
FROM {customer}
"""

VIEWS["grade_docs"] = """
SELECT o_orderkey AS doc_id, CAST(o_orderdate AS DATE) AS run_date,
       concat('{"overall": {"grade": ', CAST(30 + o_orderkey % 60 AS VARCHAR(20)), '}, "research": {"grade": ', CASE WHEN o_orderkey % 7 = 0 THEN 'null' ELSE CAST(20 + o_orderkey % 70 AS VARCHAR(20)) END,
       ', "components": {"scanner": {"grade": ', CAST(o_orderkey % 100 AS VARCHAR(20)), ', "letter": "B"}, "sector_teams": [{"team_id": "t1", "grade": ', CAST(o_orderkey % 91 AS VARCHAR(20)), '}, {"team_id": "t2", "grade": null}]}}, "predictor": {"grade": ',
       CAST(o_orderkey % 83 AS VARCHAR(20)), ', "components": {"veto_gate": {"grade": ', CAST(o_orderkey % 77 AS VARCHAR(20)), '}}}}') AS body
FROM {orders}
"""

VIEWS["sector_map_docs"] = """
SELECT concat('{"S', CAST(s_suppkey AS VARCHAR(20)), '": "X', CAST(s_nationkey % 5 AS VARCHAR(20)), '"}') AS body FROM {supplier}
"""

VIEWS["account_days"] = f"""
SELECT event_id AS snapshot_id, concat('A', CAST(user_id AS VARCHAR(20))) AS account, CAST(ts AS DATE) AS date,
       {r('100000 + value * 100', 2)} AS portfolio_nav,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE {r('5000 + value', 2)} END AS total_cash,
       CASE WHEN event_id % 7 = 0 THEN '{{}}'
            ELSE concat('{{"T', CAST(user_id % 40 AS VARCHAR(20)), '": {{"shares": ', CAST(event_id % 5 AS VARCHAR(20)), ', "avg_cost": ', CAST(event_id % 100 AS VARCHAR(20)), ', "sector": "Sec', CAST(user_id % 5 AS VARCHAR(20)),
                 '"}}, "T', CAST(40 + event_id % 40 AS VARCHAR(20)), '": {{"shares": ', CAST(1 + event_id % 9 AS VARCHAR(20)), ', "avg_cost": ', CAST(event_id % 77 AS VARCHAR(20)), ', "sector": "Sec1"}}}}') END AS positions_snapshot
FROM {{events}} WHERE event_type IN ('purchase', 'click')
"""

# --- sweep grid and what each combination traded ------------------------------

# Parameters of the sweep as whole numbers, the values tried, and the ones in use now.
SWEEP_PARAMS = ["min_score", "position_bp", "atr_tenths", "exit_days", "profit_bp"]
SWEEP_NOW = {"min_score": 92, "position_bp": 300, "atr_tenths": 25, "exit_days": 15, "profit_bp": 200}
SWEEP_TRIALS, ROW_TRIALS = 400, 12

VIEWS["sweep_values"] = """
SELECT 'min_score' AS param, CAST(50 + l_quantity AS BIGINT) AS value FROM {lineitem} WHERE l_quantity >= 30 AND l_quantity % 5 = 0
UNION SELECT 'position_bp', CAST(round(l_discount * 10000) AS BIGINT) FROM {lineitem} WHERE l_discount > 0.005e0 AND l_discount < 0.055e0
UNION SELECT 'atr_tenths', CAST(20 + 5 * (l_linenumber % 4) AS BIGINT) FROM {lineitem}
UNION SELECT 'exit_days', CAST(10 + 5 * (l_linenumber % 3) AS BIGINT) FROM {lineitem}
UNION SELECT 'profit_bp', CAST(round(l_tax * 10000) AS BIGINT) FROM {lineitem} WHERE l_tax > 0.005e0 AND l_tax < 0.045e0
UNION """ + " UNION ".join(f"SELECT '{k}', CAST({v} AS BIGINT)" for k, v in SWEEP_NOW.items())

#: From the whole numbers of a combination to the parameters of the rules.
SWEEP_COLUMNS = [
    "CAST(min_score AS DOUBLE) AS min_score", "position_bp / 10000e0 AS max_position_pct", "atr_tenths / 10e0 AS atr_multiplier",
    "CAST(floor(exit_days / 2e0) AS INT) AS time_decay_reduce_days", "CAST(exit_days AS INT) AS time_decay_exit_days",
    "profit_bp / 10000e0 AS profit_take_pct",
]

VIEWS["sweep_combos"] = f"""
SELECT CAST(row_number() OVER (ORDER BY draw) - 1 AS INT) AS combo_id, {', '.join(SWEEP_COLUMNS)}
FROM (SELECT *, md5(concat('42', {', '.join(f"'|', CAST({p} AS VARCHAR)" for p in SWEEP_PARAMS)})) AS draw
      FROM {', '.join(f"(SELECT value AS {p} FROM {{sweep_values}} WHERE param = '{p}')" for p in SWEEP_PARAMS)}
      ORDER BY draw LIMIT {SWEEP_TRIALS})
"""

# The first trials of the draw, for the results that have a row per order, holding or candidate.
VIEWS["combos"] = f"SELECT * FROM {{sweep_combos}} WHERE combo_id < {ROW_TRIALS}"

# What is ordered depends on two of the parameters only: combinations alike in these share one path.
VIEWS["paths"] = """
SELECT CAST(row_number() OVER (ORDER BY min_score, max_position_pct) - 1 AS INT) AS combo_id, min_score, max_position_pct
FROM (SELECT DISTINCT min_score, max_position_pct FROM {sweep_combos})
"""


def _orders(combos: str) -> str:
    return f"""
SELECT c.combo_id, t.trade_id AS seq, t.date, t.ticker, t.action,
       CAST(CASE WHEN t.action = 'REDUCE' THEN floor(t.shares * c.max_position_pct * 10 / 2e0) ELSE floor(t.shares * c.max_position_pct * 20) END AS DOUBLE) AS shares,
       t.fill_price AS price, t.position_pct, t.exit_reason
FROM {{trades}} t JOIN {{{combos}}} c ON t.research_score >= c.min_score
"""


VIEWS["order_log"], VIEWS["path_log"] = _orders("combos"), _orders("paths")


# Two runs of every trade: at its own size, and all at the mean size of the entries (rounded, as orders are whole shares).
VIEWS["sizing_log"] = f"""
SELECT z.combo_id, z.trade_id AS seq, z.date, z.ticker, z.action,
       CAST(CASE WHEN z.action = 'REDUCE' THEN floor(z.shares * z.pct * 10 / 2e0) ELSE floor(z.shares * z.pct * 20) END AS DOUBLE) AS shares,
       z.fill_price AS price, z.position_pct, z.exit_reason
FROM (SELECT 'sized' AS combo_id, t.*, t.position_pct AS pct FROM {{trades}} t
      UNION ALL SELECT 'equal', t.*, m.pct FROM {{trades}} t, (SELECT {r('avg(position_pct)')} AS pct FROM {{trades}} WHERE action = 'ENTER') m) z
"""


VIEWS["market_state"] = f"""
SELECT {_T} AS ticker, c.date, CASE WHEN c.okey % 31 = 0 THEN NULL ELSE c.px END AS close, {r('c.px_hi + 1', 4)} AS high,
       CASE WHEN c.okey % 8 = 0 THEN NULL ELSE {r('1 + c.disc * 60', 4)} END AS atr_dollar, 20 + c.qmax AS rsi_14,
       CASE WHEN c.okey % 12 = 0 THEN NULL ELSE {r('c.tax * 500 - 25', 4)} END AS momentum_20d, {r('c.disc * 4 - 0.2e0', 4)} AS lookback_return
FROM {{cells}} c
"""

VIEWS["ticker_sectors"] = """
SELECT concat('S', CAST(s_suppkey AS VARCHAR(20))) AS ticker, r_name AS sector, concat('X', CAST(r_regionkey AS VARCHAR(20))) AS sector_etf
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

VIEWS["fund_returns"] = f"""
SELECT d.sector_etf, m.date, {r('avg(m.lookback_return)', 4)} AS fund_return
FROM {{market_state}} m JOIN {{ticker_sectors}} d ON m.ticker = d.ticker WHERE d.sector_etf <> 'X4' GROUP BY d.sector_etf, m.date
"""

# Buy candidates with everything the entry rules look at.
VIEWS["candidates"] = f"""
SELECT {_T} AS ticker, c.date, 50 + c.qmax AS score,
       CASE c.pkey % 3 WHEN 0 THEN 'declining' WHEN 1 THEN 'stable' ELSE 'rising' END AS conviction,
       CASE c.okey % 4 WHEN 0 THEN 'overweight' WHEN 1 THEN 'underweight' ELSE 'market_weight' END AS sector_rating,
       CASE WHEN c.pkey % 5 = 0 THEN NULL ELSE {r('c.disc * 2', 4)} END AS upside,
       CASE WHEN c.pkey % 7 = 0 THEN NULL ELSE {r('0.005e0 + c.tax', 4)} END AS atr_pct,
       CASE WHEN c.okey % 6 = 0 THEN NULL ELSE {r('0.5e0 + (c.okey % 50) / 100e0', 4)} END AS confidence,
       CASE WHEN c.okey % 9 = 0 THEN NULL ELSE {r('(c.pkey % 100) / 100e0', 4)} END AS p_up,
       CASE WHEN c.pkey % 11 < 4 THEN NULL ELSE CAST(c.pkey % 11 AS INT) END AS days_to_earnings,
       CASE WHEN c.okey % 5 = 0 THEN NULL ELSE {r('(c.okey % 10) / 10e0', 4)} END AS coverage,
       CASE WHEN c.okey % 12 = 0 THEN NULL ELSE {r('c.tax * 300 - 8', 4)} END AS momentum_20d,
       c.okey % 15 = 0 AS model_veto, CAST(c.pkey % 12 AS INT) AS signal_age_days,
       CASE WHEN c.okey % 31 = 0 THEN NULL ELSE c.px END AS price
FROM {{cells}} c WHERE {_TOTAL} >= 75
"""


def placeholders(text: str) -> list[str]:
    return [n for n in dict.fromkeys(re.findall(r"\{([a-z_]+)\}", text)) if n in VIEWS or n in BASE]


def _fill(text: str, names: dict[str, str]) -> str:
    for name, value in names.items():
        text = text.replace("{" + name + "}", value)
    return text


# Aggregated or windowed views that several operators of one query read.  On a
# cluster that names a shared folder they are written once per application, so
# the fact table is not scanned again for each of them; a written table also
# survives the loss of executors.  Without such a folder they stay lazy.
SHARED = {
    "cells", "round_trips", "predictor_outcomes", "universe_returns", "brand_bars",
    "event_bars", "features", "event_outcomes", "market_state",
}
# A kept table may be far larger than the shuffle partitions of the session were chosen for, and a task with too many
# groups or rows to sort spills.  Such a table is written from many partitions, as many as a map task deals to without
# sorting its rows, and adaptive execution puts small ones together by their measured size.  A join of which one side was
# measured to be small in every partition is hashed there; sorting both sides by a ticker's text takes longer.
WRITE_PARTS, WRITE_PART_SIZE, HASHED_PART_SIZE = 200, "16m", "32m"


@contextmanager
def small_parts(spark: SparkSession) -> Iterator[None]:
    parts = max(WRITE_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": WRITE_PART_SIZE,
              "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": HASHED_PART_SIZE,
              # the shuffle files behind a written table are of no use any more
              "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# What a view's table is replaced by on the Spark side.  A key that few rows share gains nothing from a partial
# aggregate before the shuffle, which would hold a buffer per row and spill: rows are dealt by that key first, and the
# whole aggregate runs where they arrive.
DEALT: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "cells": ("lineitem", lambda d: d.withColumn("l_shipdate", F.col("l_shipdate").cast("date")).repartition("l_suppkey", "l_shipdate")),
    "predictor_outcomes": ("orders", lambda d: d.withColumn("o_orderdate", F.col("o_orderdate").cast("date")).repartition(
        F.floor(F.col("o_custkey") / 15.0), "o_orderdate")),
    # a cell that is not entered gives the later exit of another one its day and price; nothing else of it is shuffled
    "round_trips": ("cells", lambda d: d.withColumns({
        n: F.when(F.expr(f"{_TOTAL.replace('c.', '')} >= 75"), F.col(n)) for n in ("okey", "pkey", "qmax", "disc")})),
}

# The views below take a remainder of a mean.  A sum of doubles depends in its last bit on the order of its rows, and where
# the mean is a multiple that bit decides a whole period; so values are added in the order of their events, as a reader of
# the table in its order adds them, however the rows are dealt to files and tasks.
def _in_order(events: DataFrame) -> DataFrame:
    w = Window.partitionBy(F.expr("concat('U', CAST(user_id AS STRING))"), F.expr("CAST(ts AS DATE)")).orderBy("event_id", "value")
    return events.withColumn("value_so_far", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)))


DEALT["features"] = ("events", _in_order)
DEALT["event_outcomes"] = ("events", lambda d: _in_order(d.filter("event_type IN ('purchase', 'view')")))
STEADY_MEANS = {"features", "event_outcomes"}


def steady_means(text: str) -> str:
    return text.replace("avg(value)", "(max_by(value_so_far, event_id) / nullif(count(value), 0))")


# An aggregate that holds a string sorts its rows, and is not compiled.  Of these strings only the letters compared below
# are read by any view, so a small number that orders alike is aggregated instead, and the letter put back.
COMPARED = {
    "cells": ("max(l_returnflag)",
              "CASE max(CASE WHEN l_returnflag < 'R' THEN 0 WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag > 'R' THEN 2 END) WHEN 1 THEN 'R' END"),
    "predictor_outcomes": ("max_by(o_orderstatus, o_orderkey)",
                           "CASE max_by(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END, o_orderkey) WHEN 1 THEN 'F' WHEN 2 THEN 'O' END"),
}


# Views that library operators build on the Spark side; their text above is for the oracle.
BUILT: dict[str, Callable[[Tables], DataFrame]] = {}
_written: set[str] = set()
_plans: dict[tuple[str, int, str], tuple[SparkSession, dict[str, DataFrame]]] = {}


class Tables:
    """Lazy access to base tables and domain views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        # plans are immutable: queries of one session share the resolved ones
        key = (spark.sparkContext.applicationId, id(spark), sf_dir)
        self._cache: dict[str, DataFrame] = _plans.setdefault(key, (spark, {}))[1]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in VIEWS and name not in BASE):
            raise AttributeError(name)
        if name not in self._cache:
            if name in BASE:
                df = self._base(name)
            else:
                df = self.kept(name, lambda: BUILT[name](self)) if name in BUILT else self._shared(name) if name in SHARED else self._view(name)
            self._cache[name] = df
        return self._cache[name]

    def _base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _shared(self, name: str) -> DataFrame:
        return self.kept(name, lambda: self._view(name))

    def kept(self, name: str, build) -> DataFrame:
        """A result several queries start from: written once per application to the
        shared folder, or simply built when no such folder is set."""
        folder = self.spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            return build()
        app = self.spark.sparkContext.applicationId
        path = f"{folder.rstrip('/')}/assay/{app}/{re.sub(r'[^0-9A-Za-z]+', '_', self.sf_dir)}/{name}"
        if path not in _written:
            with small_parts(self.spark):
                build().write.mode("overwrite").option("compression", "zstd").parquet(path)
            _written.add(path)
        return self.spark.read.parquet(path)

    def _view(self, name: str) -> DataFrame:
        # registered under a private name; Spark resolves the plan right away
        needed = placeholders(VIEWS[name])
        names = {n: f"__assay_{n}" for n in needed}
        for n in needed:
            getattr(self, n).createOrReplaceTempView(names[n])
        if name in DEALT:
            table, deal = DEALT[name]
            names[table] = f"__assay_{table}_for_{name}"
            deal(getattr(self, table)).createOrReplaceTempView(names[table])
        text = steady_means(VIEWS[name]) if name in STEADY_MEANS else VIEWS[name].replace(*COMPARED.get(name, ("", "")))
        return self.spark.sql(_fill(text, names))


def oracle_ctes(used: list[str]) -> str:
    """WITH prefix that defines the used views and everything below them."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in BASE or name in order:
            return
        for dep in placeholders(VIEWS[name]):
            visit(dep)
        order.append(name)

    for name in used:
        visit(name)
    parts = [f"{n} AS ({_fill(VIEWS[n], {d: d for d in placeholders(VIEWS[n])}).strip()})" for n in order]
    return ",\n".join(parts)
