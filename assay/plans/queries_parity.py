"""Permutation test and live / replay comparison with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.functions.scalars import rnd
from assay.operators import montecarlo as MC
from assay.operators import parity as PY
from assay.plans.registry import query
from assay.plans.views import r

_SIG = "(SELECT u.ticker, u.eval_date AS date, t.quant_score AS score, u.return_5d AS stock_return, u.spy_return_5d AS spy_return FROM {universe_returns} u JOIN {team_candidates} t USING (ticker, eval_date) WHERE u.return_5d IS NOT NULL)"
_TOP = "SELECT avg(a) AS alpha, count(*) AS n FROM (SELECT avg(stock_return) - avg(spy_return) AS a FROM (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY date ORDER BY score DESC, ticker) <= 2) GROUP BY date)"


def signals(t):
    return t.universe_returns.join(t.team_candidates, ["ticker", "eval_date"]).filter("return_5d IS NOT NULL").select(
        "ticker", F.col("eval_date").alias("date"), F.col("quant_score").alias("score"),
        F.col("return_5d").alias("stock_return"), F.col("spy_return_5d").alias("spy_return"))


@query("top_n_alpha", f"WITH b AS {_SIG} SELECT {r('alpha')} AS alpha, n AS n_dates FROM ({_TOP})")
def _(t):
    return MC.top_n_alpha(signals(t), 2).withColumn("alpha", rnd("alpha", 6))


_TOP5 = _TOP.replace("<= 2", "<= 5")


def _draws(n: int) -> str:
    """CTEs q1 to qn: draw k of every (permutation, date), a place that was drawn before replaced by the last one."""
    out = []
    for k in range(n):
        t = f"CAST(concat('0x', substr(md5(concat('42|', CAST(perm AS VARCHAR), '|', CAST(date AS VARCHAR), '|{k // 5}')), {1 + 6 * (k % 5)}, 6)) AS BIGINT) % (n - {n - k - 1})"
        seen = f"t IN ({', '.join(f'p{i}' for i in range(k))})" if k else "false"
        out.append(f"q{k + 1} AS (SELECT * EXCLUDE (t), CASE WHEN {seen} THEN n - {n - k} ELSE t END AS p{k} FROM (SELECT *, {t} AS t FROM q{k} WHERE n > {n}))")
    return ", ".join(out)


_NULL = f"""q0 AS (SELECT date, n, perm FROM (SELECT date, count(*) AS n FROM b GROUP BY date), (SELECT unnest(range(1000)) AS perm)), {_draws(5)},
 pk AS (SELECT perm, date, unnest([p0, p1, p2, p3, p4]) AS place FROM q5 UNION ALL SELECT perm, date, unnest(range(n)) AS place FROM q0 WHERE n <= 5),
 nb AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY ticker, stock_return, spy_return, score) - 1 AS place FROM b),
 nl AS (SELECT perm, avg(a) AS alpha FROM (SELECT perm, date, avg(stock_return) - avg(spy_return) AS a FROM pk JOIN nb USING (date, place) GROUP BY 1, 2) GROUP BY 1)"""


@query("permutation_test", f"""WITH k AS {_SIG}, b AS (SELECT * FROM k WHERE score >= 70), {_NULL}, ac AS ({_TOP5}),
 z AS (SELECT count(*) AS m, count(CASE WHEN nl.alpha >= ac.alpha THEN 1 END) AS ge, max(ac.alpha) AS act, max(ac.n) AS nd, avg(nl.alpha) AS mu, stddev_pop(nl.alpha) AS sd, min(nl.alpha) AS lo, max(nl.alpha) AS hi FROM nl, ac)
 SELECT 'ok' AS status, {r('act', 4)} AS actual_alpha, {r('ge * 1e0 / m', 4)} AS p_value, {r('(1 - ge * 1e0 / m) * 100', 1)} AS percentile, {r('mu', 4)} AS null_mean, {r('sd', 4)} AS null_std, {r('lo', 4)} AS null_min, {r('hi', 4)} AS null_max,
  m AS n_permutations, (SELECT count(*) FROM b) AS n_signals, nd AS n_signal_dates, CASE WHEN ge * 1e0 / m < 0.05e0 THEN 'significant' ELSE 'not_significant' END AS conclusion FROM z""")
def _(t):
    return MC.permutation_test(signals(t))


LIVE = "(SELECT * FROM {trades} WHERE action = 'ENTER')"
REPLAY = """(SELECT ticker, action, signal_trading_day, shares + CAST(trade_id % 4 AS INT) AS shares, price_at_order * CASE WHEN trade_id % 5 = 0 THEN 1.002e0 ELSE 1.0005e0 END AS price_at_order, research_score + CASE WHEN trade_id % 9 = 0 THEN 0.7e0 ELSE 0e0 END AS research_score,
   CASE WHEN trade_id % 11 = 0 THEN NULL ELSE position_pct END AS position_pct, CASE WHEN trade_id % 8 = 0 THEN NULL ELSE predicted_direction END AS predicted_direction
 FROM {trades} WHERE action = 'ENTER' AND trade_id % 13 <> 0
 UNION ALL SELECT concat(ticker, 'x'), action, signal_trading_day, shares, price_at_order, research_score, position_pct, predicted_direction FROM {trades} WHERE action = 'ENTER' AND trade_id % 17 = 0)"""


def live(t):
    return t.trades.filter("action = 'ENTER'")


def replay(t):
    e = live(t)
    k = F.col("trade_id")
    cols = ["ticker", "action", "signal_trading_day", "shares", "price_at_order", "research_score", "position_pct", "predicted_direction"]
    shifted = e.filter(k % 13 != 0).select(
        "ticker", "action", "signal_trading_day", (F.col("shares") + (k % 4).cast("int")).alias("shares"),
        (F.col("price_at_order") * F.when(k % 5 == 0, 1.002).otherwise(1.0005)).alias("price_at_order"),
        (F.col("research_score") + F.when(k % 9 == 0, 0.7).otherwise(0.0)).alias("research_score"),
        F.when(k % 11 != 0, F.col("position_pct")).alias("position_pct"),
        F.when(k % 8 != 0, F.col("predicted_direction")).alias("predicted_direction"))
    return shifted.unionByName(e.filter(k % 17 == 0).withColumn("ticker", F.concat("ticker", F.lit("x"))).select(*cols))


def _day(src: str, n: str) -> str:
    return f"(SELECT signal_trading_day AS date, count(*) AS {n} FROM {src} GROUP BY 1)"


@query("trade_count_divergence", f"""SELECT CAST(date AS VARCHAR) AS date, l AS live, rp AS replay, rp - l AS diff, {r('abs(rp - l) * 1e0 / greatest(l, 1)', 4)} AS pct FROM (
  SELECT date, coalesce(a.l, 0) AS l, coalesce(b.rp, 0) AS rp FROM {_day(LIVE, 'l')} a FULL JOIN {_day(REPLAY, 'rp')} b USING (date)) WHERE abs(rp - l) * 1e0 / greatest(l, 1) > 0.05e0""")
def _(t):
    return PY.count_divergence(live(t), replay(t))


_ONLY = f"""(SELECT *, 'only_live' AS side FROM (SELECT signal_trading_day AS date, ticker FROM {LIVE} EXCEPT SELECT signal_trading_day, ticker FROM {REPLAY})
  UNION ALL SELECT *, 'only_replay' FROM (SELECT signal_trading_day AS date, ticker FROM {REPLAY} EXCEPT SELECT signal_trading_day, ticker FROM {LIVE}))"""


@query("ticker_set_differences", f"SELECT CAST(date AS VARCHAR) AS date, ticker, side FROM {_ONLY} WHERE date IN (SELECT date FROM {_ONLY} GROUP BY 1 HAVING count(*) > 1)")
def _(t):
    return PY.ticker_differences(live(t), replay(t))


_M = f"(SELECT a.signal_trading_day, a.ticker, a.action, a.shares AS s1, b.shares AS s2, a.price_at_order AS p1, b.price_at_order AS p2, a.research_score AS r1, b.research_score AS r2, a.position_pct AS w1, b.position_pct AS w2, a.predicted_direction AS d1, b.predicted_direction AS d2 FROM {LIVE} a JOIN {REPLAY} b ON a.signal_trading_day = b.signal_trading_day AND a.ticker = b.ticker AND a.action = b.action)"


def _abs(a, b, tol):
    return f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN false WHEN {a} IS NULL OR {b} IS NULL THEN true ELSE NOT ({tol}) END"


_V = f"""(SELECT signal_trading_day, ticker, action, 'predicted_direction' AS field FROM {_M} WHERE d1 IS DISTINCT FROM d2 UNION ALL SELECT signal_trading_day, ticker, action, 'shares' FROM {_M} WHERE abs(s1 - s2) > 1
 UNION ALL SELECT signal_trading_day, ticker, action, 'price_at_order' FROM {_M} WHERE {_abs('p1', 'p2', 'abs(p1) > 1e-9 AND abs(p1 - p2) / abs(p1) <= 0.001e0')}
 UNION ALL SELECT signal_trading_day, ticker, action, 'research_score' FROM {_M} WHERE {_abs('r1', 'r2', 'abs(r1 - r2) <= 0.5e0')}
 UNION ALL SELECT signal_trading_day, ticker, action, 'position_pct' FROM {_M} WHERE {_abs('w1', 'w2', 'abs(w1 - w2) <= 0.005e0')})"""


@query("trade_field_differences", f"SELECT CAST(signal_trading_day AS VARCHAR) AS signal_trading_day, ticker, action, field FROM {_V}")
def _(t):
    return PY.field_differences(live(t), replay(t)).drop("live", "replay")


@query("parity_metrics", f"""WITH nm AS (SELECT date, ticker, l, rp FROM (SELECT signal_trading_day AS date, ticker, count(*) AS l FROM {LIVE} GROUP BY 1, 2) a FULL JOIN (SELECT signal_trading_day AS date, ticker, count(*) AS rp FROM {REPLAY} GROUP BY 1, 2) b USING (date, ticker)),
 dy AS (SELECT date, coalesce(sum(l), 0) AS l, coalesce(sum(rp), 0) AS rp, count(CASE WHEN l IS NOT NULL AND rp IS NOT NULL THEN 1 END) * 1e0 / count(*) AS j FROM nm GROUP BY 1)
 SELECT {r('sum(rp) * 1e0 / sum(l)', 4)} AS capture_rate, {r('avg(j)', 4)} AS ticker_jaccard_avg, {r('sqrt(avg(pow(rp - l, 2)))', 4)} AS count_divergence_rms, {r(f'(SELECT count(*) FROM {_V}) * 1e0 / (SELECT count(*) FROM {_M})', 4)} AS field_diff_rate,
  CAST(sum(l) AS BIGINT) AS n_live, CAST(sum(rp) AS BIGINT) AS n_replay, (SELECT count(*) FROM {_M}) AS n_matched, (SELECT count(*) FROM {_V}) AS n_field_violations, count(*) AS n_dates FROM dy""")
def _(t):
    return PY.parity_metrics(live(t), replay(t))
