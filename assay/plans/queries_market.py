"""Price, calendar, indicator and scoring queries with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.operators import asof as A
from assay.operators import indicators as I
from assay.operators import prices as P
from assay.plans.registry import query
from assay.plans.views import r

ASOF = "2024-01-31"
CAL = "(SELECT date, row_number() OVER (ORDER BY date) - 1 AS pos, lead(date) OVER (ORDER BY date) AS next_date FROM (SELECT DISTINCT date FROM {event_bars}))"


def _raw(t):
    """Unreduced price rows: every event of a user is a row of that day."""
    return t.events.select(
        F.when(F.col("user_id") % 10 == 0, "SPY").otherwise(F.concat(F.lit("U"), F.col("user_id").cast("string"))).alias("ticker"),
        F.col("ts").cast("date").alias("date"), F.col("value").alias("close"), (F.col("value") + 1).alias("high"),
        F.lit(1.0).alias("volume"), "event_id", F.when(F.col("event_id") % 3 != 0, F.col("value") / 2).alias("f1"))


_RAW = "(SELECT CASE WHEN user_id % 10 = 0 THEN 'SPY' ELSE concat('U', CAST(user_id AS VARCHAR)) END AS ticker, CAST(ts AS DATE) AS date, value AS close, value + 1 AS high, 1e0 AS volume, event_id, CASE WHEN event_id % 3 <> 0 THEN value / 2 END AS f1 FROM {events})"
_LAST = f"(SELECT * FROM {_RAW} QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY event_id DESC) = 1)"
_ALLOW = "(SELECT DISTINCT concat('U', CAST(user_id AS VARCHAR)) AS ticker FROM {events} WHERE user_id % 4 = 1)"
_SPYFB = "(SELECT 'VIX' AS ticker, CAST(ts AS DATE) AS date, value AS close, event_id FROM {events} WHERE event_type = 'view')"


def _universe(t):
    allow = t.events.filter("user_id % 4 = 1").select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"))
    macro = t.events.filter("event_type IN ('view', 'click')").select(
        F.when(F.col("event_type") == "view", "VIX").otherwise("SPY").alias("ticker"), F.col("ts").cast("date").alias("date"),
        F.col("value").alias("close"), "event_id")
    return P.load_universe(_raw(t), macro, "event_id", allow)


@query("universe_prices", f"""SELECT ticker, CAST(date AS VARCHAR) AS date, high, close, volume FROM {_LAST} WHERE ticker = 'SPY' OR ticker IN {_ALLOW.replace('(SELECT DISTINCT', '(SELECT', 1)}
 UNION ALL SELECT ticker, CAST(date AS VARCHAR), NULL, close, NULL FROM (SELECT * FROM {_SPYFB} QUALIFY row_number() OVER (PARTITION BY date ORDER BY event_id DESC) = 1)""")
def _(t):
    """Last row per day wins, allowlist for stocks, macro series kept or taken from their own table."""
    return _universe(t)[0]


@query("universe_features", f"SELECT ticker, CAST(date AS VARCHAR) AS date, close, high, volume, f1 FROM {_LAST} WHERE ticker IN {_ALLOW}")
def _(t):
    return _universe(t)[1]


@query("read_quality", """SELECT n_expected, n_missing, floor(n_missing * 1e0 / n_expected * 1e4 + 0.5000001e0) / 1e4 AS error_rate,
  CASE WHEN n_missing * 1e0 / n_expected > 0.05e0 THEN 'failed' ELSE 'ok' END AS status FROM (
  SELECT count(*) AS n_expected, count(CASE WHEN e.ticker IS NULL THEN 1 END) AS n_missing FROM (SELECT DISTINCT concat('U', CAST(c_custkey AS VARCHAR)) AS ticker FROM {customer}) c
  LEFT JOIN (SELECT DISTINCT ticker FROM {event_bars}) e USING (ticker))""")
def _(t):
    expected = t.customer.select(F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("ticker"))
    return P.read_quality(expected, t.event_bars)


@query("quality_gated_prices", "SELECT ticker, CAST(date AS VARCHAR) AS date, close FROM {event_bars}")
def _(t):
    """Rows pass while every expected series is there; a failing gate stops the job."""
    gate = P.read_quality(t.event_bars.select("ticker"), t.event_bars)
    return P.require_quality(t.event_bars.select("ticker", "date", "close"), gate)


@query("price_cache_fallback", """SELECT ticker, CAST(date AS VARCHAR) AS date, close FROM {event_bars} WHERE date >= DATE '2024-01-28'
 UNION ALL SELECT ticker, CAST(date AS VARCHAR), close FROM {event_bars} WHERE ticker NOT IN (SELECT ticker FROM {event_bars} WHERE date >= DATE '2024-01-28')""")
def _(t):
    """A short recent cache first, the long one only for series the short one lacks."""
    cols = ["ticker", "date", "close"]
    return P.with_fallback(t.event_bars.filter("date >= DATE '2024-01-28'").select(*cols), t.event_bars.select(*cols))


@query("feature_scan", "SELECT ticker, CAST(date AS VARCHAR) AS date, atr_14_pct, rsi_14, momentum_20d, upside_gap, breadth, last_id FROM {features} WHERE ticker IN (SELECT symbol FROM {event_outcomes} WHERE actual_5d_return > 10)")
def _(t):
    return P.feature_scan(t.features, t.event_outcomes.filter("actual_5d_return > 10").select(F.col("symbol").alias("ticker")))


@query("history_slice", "SELECT ticker, CAST(date AS VARCHAR) AS date, high, low, close FROM {bars} WHERE date <= DATE '1996-06-30' AND ticker IN (SELECT ticker FROM {trades} WHERE shares > 95)")
def _(t):
    return P.history_until(t.bars.select("ticker", "date", "high", "low", "close"), t.trades.filter("shares > 95"), "1996-06-30")


@query("universe_freshness", f"SELECT ticker, CAST(max(date) AS VARCHAR) AS last_date, date_diff('day', max(date), DATE '{ASOF}') AS age_days FROM {{event_bars}} GROUP BY 1 HAVING date_diff('day', max(date), DATE '{ASOF}') > 1")
def _(t):
    return P.stale_series(t.event_bars, ASOF, 1)


@query("benchmark_freshness", "SELECT CAST(max(date) AS VARCHAR) AS last_date, max(date) >= DATE '2024-01-30' AS fresh FROM {event_bars} WHERE ticker = 'U10'")
def _(t):
    return P.benchmark_fresh(t.event_bars, "U10", "2024-01-30")


@query("price_staleness_tier", """SELECT CAST(max(date) AS VARCHAR) AS last_date, CASE WHEN max(date) < DATE '2024-01-29' THEN 'break' WHEN max(date) < DATE '2024-02-01' THEN 'warn' ELSE 'ok' END AS tier FROM {event_bars}""")
def _(t):
    """Asked on Monday 2024-02-05: two business days back is 02-01, five is 01-29."""
    return P.staleness_tier(t.event_bars, "2024-02-05")


@query("module_heartbeats", """SELECT m.module, CASE WHEN last_ts IS NULL THEN 'unknown' ELSE 'seen' END AS state,
  floor((epoch(TIMESTAMP '2024-02-01 12:00:00') - floor(epoch(last_ts))) / 3600e0 * 1e4 + 0.5000001e0) / 1e4 AS age_hours,
  coalesce((epoch(TIMESTAMP '2024-02-01 12:00:00') - floor(epoch(last_ts))) / 3600e0 > 48, true) AS stale
 FROM (SELECT DISTINCT event_type AS module FROM {events} UNION SELECT 'refund') m LEFT JOIN (SELECT event_type AS module, max(ts) AS last_ts FROM {events} WHERE event_type <> 'view' OR ts < TIMESTAMP '2024-01-20' GROUP BY 1) b USING (module)""")
def _(t):
    mods = t.events.select(F.col("event_type").alias("module")).distinct()
    mods = mods.unionByName(mods.limit(1).select(F.lit("refund").alias("module")))
    beats = t.events.filter("event_type <> 'view' OR ts < TIMESTAMP '2024-01-20'").select(F.col("event_type").alias("module"), "ts")
    return P.heartbeats(mods, beats, "2024-02-01 12:00:00")


@query("trading_dates", "SELECT CAST(date AS VARCHAR) AS date FROM (SELECT DISTINCT date FROM {bars} ORDER BY date DESC LIMIT 500)")
def _(t):
    return P.trading_dates(t.bars, 100, 500)


@query("trading_dates_too_few", "SELECT CAST(date AS VARCHAR) AS date FROM {event_bars} WHERE false")
def _(t):
    return P.trading_dates(t.event_bars, 100, 500)


@query("normalised_ohlc", f"SELECT ticker, CAST(date AS VARCHAR) AS date, close AS open, high, close AS low, close FROM {_LAST}")
def _(t):
    """Title-case source without open and low; the last row of a day wins."""
    raw = _raw(t).select("ticker", "date", "event_id", F.col("close").alias("Close"), F.col("high").alias("High"))
    return P.normalise_ohlc(raw, "event_id")


_GRID = f"(SELECT s.ticker, c.date, c.pos, b.close FROM (SELECT DISTINCT ticker FROM {{event_bars}}) s CROSS JOIN {CAL} c LEFT JOIN {{event_bars}} b ON b.ticker = s.ticker AND b.date = c.date)"
_FFILL = "last_value(close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY pos ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"
_FILLED = f"(SELECT *, {_FFILL} AS f FROM {_GRID})"
_BF = "first_value(f IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


@query("price_matrix", f"""SELECT ticker, CAST(date AS VARCHAR) AS date, price, CASE WHEN close IS NOT NULL THEN 'observed' WHEN f IS NOT NULL THEN 'forward' ELSE 'backward' END AS filled
 FROM (SELECT *, {_BF} AS price FROM {_FILLED}) WHERE price IS NOT NULL""")
def _(t):
    return P.price_matrix(t.event_bars, A.calendar(t.event_bars))


@query("price_matrix_leak_free", f"SELECT ticker, CAST(date AS VARCHAR) AS date, f AS price, CASE WHEN close IS NOT NULL THEN 'observed' ELSE 'forward' END AS filled FROM {_FILLED} WHERE f IS NOT NULL")
def _(t):
    return P.price_matrix(t.event_bars, A.calendar(t.event_bars), backfill=False)


@query("gap_statistics", f"""SELECT ticker, count(CASE WHEN close IS NULL THEN 1 END) AS n_missing, count(CASE WHEN price IS NULL THEN 1 END) AS n_unfilled,
  count(CASE WHEN close IS NULL THEN 1 END) > 5 AS gap_warning, count(CASE WHEN price IS NULL THEN 1 END) > 0 AS dropped FROM (SELECT *, {_BF} AS price FROM {_FILLED}) GROUP BY 1""")
def _(t):
    return P.gap_statistics(t.event_bars, A.calendar(t.event_bars))


@query("gap_statistics_leak_free", f"""SELECT ticker, count(CASE WHEN close IS NULL THEN 1 END) AS n_missing, count(CASE WHEN f IS NULL THEN 1 END) AS n_unfilled,
  count(CASE WHEN close IS NULL THEN 1 END) > 5 AS gap_warning, count(CASE WHEN f IS NULL THEN 1 END) > 0 AS dropped FROM {_FILLED} GROUP BY 1""")
def _(t):
    return P.gap_statistics(t.event_bars, A.calendar(t.event_bars), backfill=False)


@query("price_matrix_complete", f"""SELECT ticker, CAST(date AS VARCHAR) AS date, f AS price FROM {_FILLED} WHERE ticker NOT IN (SELECT ticker FROM {_FILLED} WHERE f IS NULL)""")
def _(t):
    """Series with unfilled days are dropped as a whole."""
    cal = A.calendar(t.event_bars)
    m = P.price_matrix(t.event_bars, cal, backfill=False)
    return P.drop_unfilled(m, P.gap_statistics(t.event_bars, cal, backfill=False)).drop("filled")


@query("price_fill_rate", f"SELECT count(DISTINCT ticker) AS n_tickers, count(close) AS n_filled, count(DISTINCT date) AS n_dates, {r('count(close) * 1e0 / count(*)', 4)} AS fill_rate FROM {_GRID}")
def _(t):
    return P.fill_rate(t.event_bars, A.calendar(t.event_bars))


@query("latest_features", f"""SELECT ticker, CAST(date AS VARCHAR) AS last_date, CASE WHEN atr_14_pct > 0 THEN atr_14_pct END AS atr_14_pct,
  {r('((atr_14_pct IS NOT NULL)::INT + (rsi_14 IS NOT NULL)::INT + (momentum_20d IS NOT NULL)::INT + (upside_gap IS NOT NULL)::INT + (breadth IS NOT NULL)::INT) / 5e0', 4)} AS coverage
 FROM (SELECT * FROM {{features}} QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1)""")
def _(t):
    return P.latest_features(t.features.drop("last_id"))


_EXP = "(SELECT DISTINCT date FROM {bars})"


@query("simulation_coverage", f"""SELECT n_expected, n_done, {r('n_done * 1e0 / n_expected', 4)} AS coverage, CASE WHEN n_done * 1e0 / n_expected < 0.8e0 THEN 'insufficient_coverage' ELSE 'ok' END AS status
 FROM (SELECT count(*) AS n_expected, count(m.date) AS n_done FROM {_EXP} e LEFT JOIN {{macro_snapshots}} m USING (date))""")
def _(t):
    return P.simulation_coverage(t.bars, t.macro_snapshots)


@query("simulation_skip_reasons", f"""SELECT CASE WHEN m.date IS NULL THEN 'no_signals' WHEN p.date IS NULL THEN 'no_prices' ELSE 'simulated' END AS reason, count(*) AS n_dates
 FROM {_EXP} e LEFT JOIN {{macro_snapshots}} m USING (date) LEFT JOIN (SELECT DISTINCT prediction_date AS date FROM {{predictor_outcomes}} WHERE prediction_confidence > 0.9e0) p USING (date) GROUP BY 1""")
def _(t):
    prices = t.predictor_outcomes.filter("prediction_confidence > 0.9").select(F.col("prediction_date").alias("date"))
    return P.skip_reasons(t.bars, t.macro_snapshots, prices)


# --- as-of on prices and calendars ------------------------------------------

_REC = "(SELECT ticker, date, last_value(CASE WHEN vwap > 0 THEN vwap END IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS vwap_used FROM {features})"


@query("vwap_for_dates", f"""SELECT a.ticker, CAST(a.date AS VARCHAR) AS date, CAST(f.date AS VARCHAR) AS matched_date, f.vwap_used
 FROM (SELECT DISTINCT ticker, DATE '2024-01-05' + CAST(k AS INT) * 5 AS date FROM {{event_bars}}, (VALUES (0), (1), (2), (3), (4)) v(k)) a ASOF LEFT JOIN {_REC} f ON a.ticker = f.ticker AND f.date <= a.date""")
def _(t):
    asked = t.event_bars.select("ticker").distinct().withColumn(
        "date", F.explode(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: F.date_add(F.lit("2024-01-05").cast("date"), k * 5))))
    return A.vwap_for_dates(t.features, asked)


@query("features_carried_forward", f"""SELECT s.ticker, CAST(c.date AS VARCHAR) AS date, CAST(f.date AS VARCHAR) AS source_date, f.rsi_14, f.momentum_20d
 FROM (SELECT DISTINCT ticker FROM {{features}}) s CROSS JOIN {CAL} c ASOF JOIN {{features}} f ON f.ticker = s.ticker AND f.date <= c.date""")
def _(t):
    return A.carry_forward(t.features, A.calendar(t.event_bars), ["rsi_14", "momentum_20d"])


@query("next_trading_days", """SELECT CAST(d.date AS VARCHAR) AS date, (SELECT CAST(min(m.date) AS VARCHAR) FROM {macro_snapshots} m WHERE m.date >= d.date) AS trading_date FROM (SELECT DISTINCT score_date AS date FROM {scored_signals}) d""")
def _(t):
    """Signal dates mapped onto a calendar that skips some days."""
    cal = A.calendar(t.macro_snapshots)
    return A.next_trading_day(t.scored_signals.select(F.col("score_date").alias("date")), cal)


@query("entry_fill_shift", """SELECT trade_id, action, CAST(t.date AS VARCHAR) AS date, CAST(CASE WHEN action = 'ENTER' THEN c.next_date ELSE t.date END AS VARCHAR) AS fill_date FROM {trades} t
 LEFT JOIN (SELECT date, lead(date) OVER (ORDER BY date) AS next_date FROM {macro_snapshots}) c ON c.date = t.date WHERE action <> 'ENTER' OR c.next_date IS NOT NULL""")
def _(t):
    return A.shift_entries_to_next_day(t.trades, A.calendar(t.macro_snapshots)).select("trade_id", "action", "date", "fill_date")


_SIG = "(SELECT ticker, date, CASE WHEN volume >= 3 THEN 'buy' ELSE 'universe' END AS bucket, close FROM {event_bars} WHERE day(date) % 4 <> 0)"


@query("carried_signals", f"""SELECT ticker, CAST(c.date AS VARCHAR) AS date, CAST(s.date AS VARCHAR) AS signal_date, bucket, close FROM {CAL} c JOIN (
   SELECT c.date AS day, max(s.date) AS src FROM {CAL} c JOIN (SELECT DISTINCT date FROM {_SIG}) s ON s.date <= c.date GROUP BY 1) m ON m.day = c.date JOIN {_SIG} s ON s.date = m.src WHERE s.date = c.date OR bucket <> 'buy'""")
def _(t):
    """No signals every fourth day; the day then repeats the last ones without the buy bucket."""
    sig = t.event_bars.filter("day(date) % 4 <> 0").select(
        "ticker", "date", F.when(F.col("volume") >= 3, "buy").otherwise("universe").alias("bucket"), "close")
    return A.carry_signals(sig, A.calendar(t.event_bars))


@query("recent_cohort", """SELECT trade_id, ticker, action FROM {trades} WHERE coalesce(signal_trading_day, date) IN (SELECT DISTINCT coalesce(signal_trading_day, date) AS d FROM {trades} ORDER BY d DESC LIMIT 30)""")
def _(t):
    return A.within_last_dates(t.trades, F.coalesce("signal_trading_day", "date"), 30).select("trade_id", "ticker", "action")


# --- indicators ----------------------------------------------------------------

def _ew(x: str, alpha: str, first: str = "0") -> str:
    """Recursive average in closed form: seed at row ``first``, then alpha-weighted terms."""
    b = f"(1e0 - {alpha})"
    return (f"(pow({b}, i - {first}) * sum(CASE WHEN i < {first} THEN 0e0 WHEN i = {first} THEN {x} ELSE {alpha} * {x} * pow({b}, {first} - i) END) "
            f"OVER (PARTITION BY ticker ORDER BY i ROWS UNBOUNDED PRECEDING))")


IND = f"""i0 AS (SELECT ticker, date, close, row_number() OVER w - 1 AS i, close - lag(close) OVER w AS mv, close / lag(close, 20) OVER w AS m20,
    CASE WHEN count(*) OVER w50 = 50 THEN avg(close) OVER w50 END AS a50, CASE WHEN count(*) OVER w200 = 200 THEN avg(close) OVER w200 END AS a200
  FROM {{brand_bars}} WINDOW w AS (PARTITION BY ticker ORDER BY date), w50 AS (PARTITION BY ticker ORDER BY date ROWS 49 PRECEDING), w200 AS (PARTITION BY ticker ORDER BY date ROWS 199 PRECEDING)),
i1 AS (SELECT *, {_ew('greatest(mv, 0e0)', '(1e0 / 14)', '1')} AS up, {_ew('-least(mv, 0e0)', '(1e0 / 14)', '1')} AS dn, {_ew('close', '(2e0 / 13)')} - {_ew('close', '(2e0 / 27)')} AS macd FROM i0),
i2 AS (SELECT *, macd - {_ew('macd', '(2e0 / 10)')} AS gap FROM i1),
i3 AS (SELECT *, CASE WHEN gap >= 0 AND lag(gap) OVER w < 0 THEN 1e0 WHEN gap < 0 AND lag(gap) OVER w >= 0 THEN -1e0 END AS raw FROM i2 WINDOW w AS (PARTITION BY ticker ORDER BY i)),
ind AS (SELECT ticker, date, close, i + 1 AS bar_no, CASE WHEN i > 0 AND dn <> 0 THEN 100 - 100 / (1 + up / dn) END AS rsi_14,
  coalesce(last_value(raw IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY i ROWS 2 PRECEDING), 0e0) AS macd_cross, macd > 0 AS macd_above_zero,
  (close - a50) / a50 * 100 AS price_vs_ma50, (close - a200) / a200 * 100 AS price_vs_ma200, (m20 - 1) * 100 AS momentum_20d FROM i3)"""
_ROUNDED = ["rsi_14", "price_vs_ma50", "price_vs_ma200", "momentum_20d"]


@query("technical_indicators", f"""WITH {IND} SELECT ticker, CAST(date AS VARCHAR) AS date, close, bar_no, macd_cross, macd_above_zero, {', '.join(f'{r(c, 5)} AS {c}' for c in _ROUNDED)} FROM ind""")
def _(t):
    from assay.functions.scalars import rnd
    s = I.indicator_series(t.brand_bars)
    return s.select("ticker", "date", "close", "bar_no", "macd_cross", "macd_above_zero", *[rnd(c, 5).alias(c) for c in _ROUNDED])


@query("usable_indicators", f"WITH {IND} SELECT ticker, count(*) AS n, CAST(min(date) AS VARCHAR) AS first_date FROM ind WHERE bar_no >= 210 AND rsi_14 IS NOT NULL GROUP BY 1")
def _(t):
    return I.usable_indicators(I.indicator_series(t.brand_bars)).groupBy("ticker").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"))


@query("lookback_returns", f"""SELECT ticker, CAST(date AS VARCHAR) AS date, {r('CASE WHEN prior > 0 THEN close / prior - 1 END', 8)} AS lookback_return FROM (SELECT *, lag(close, 20) OVER (PARTITION BY ticker ORDER BY date) AS prior FROM {{brand_bars}})""")
def _(t):
    from assay.functions.scalars import rnd
    return I.lookback_return(t.brand_bars.select("ticker", "date", "close")).select(
        "ticker", "date", rnd("lookback_return", 8).alias("lookback_return"))


def _ma(c):
    return f"CASE WHEN {c} IS NULL THEN 50e0 WHEN {c} >= 5 THEN least(100e0, 80 + ({c} - 5) * (20e0 / 15)) WHEN {c} >= 0 THEN 50 + {c} * 6 WHEN {c} > -5 THEN 50 + {c} * 4 ELSE greatest(0e0, 30 - (abs({c}) - 5) * 1.5e0) END"


_TOP, _BOT, _FULL = "CASE WHEN reg = 'bull' THEN 80e0 ELSE 70e0 END", "CASE WHEN reg IN ('bear', 'caution') THEN 40e0 ELSE 30e0 END", "CASE WHEN reg IN ('bear', 'caution') THEN 65e0 ELSE 100e0 END"
_RSI = f"CASE WHEN rsi_14 >= {_TOP} THEN 0e0 WHEN rsi_14 <= {_BOT} THEN {_FULL} ELSE {_FULL} * ({_TOP} - rsi_14) / ({_TOP} - {_BOT}) END"
_MACD = "CASE WHEN macd_cross = 1 THEN CASE WHEN macd_above_zero THEN 100e0 ELSE 70e0 END WHEN macd_cross = -1 THEN CASE WHEN macd_above_zero THEN 30e0 ELSE 0e0 END ELSE CASE WHEN macd_above_zero THEN 60e0 ELSE 40e0 END END"
SIGNALS = f"""{IND},
s0 AS (SELECT ind.*, b.alpha, coalesce(m.market_regime, 'neutral') AS reg FROM ind JOIN {{brand_bars}} b USING (ticker, date) LEFT JOIN {{macro_snapshots}} m USING (date) WHERE bar_no >= 210 AND rsi_14 IS NOT NULL),
s1 AS (SELECT *, CASE WHEN momentum_20d IS NULL THEN 50e0 ELSE {r('(row_number() OVER (PARTITION BY date ORDER BY momentum_20d NULLS LAST, ticker) - 1) * 1e0 / greatest(count(momentum_20d) OVER (PARTITION BY date) - 1, 1) * 100', 1)} END AS pct FROM s0),
s2 AS (SELECT *, {r(f'greatest(0e0, least(100e0, ({_RSI}) * 0.25e0 + ({_MACD}) * 0.2e0 + ({_ma("price_vs_ma50")}) * 0.2e0 + ({_ma("price_vs_ma200")}) * 0.2e0 + pct * 0.15e0))', 2)} AS technical_score FROM s1),
s3 AS (SELECT *, {r('greatest(0e0, least(100e0, technical_score + greatest(-10e0, least(10e0, alpha * 500))))', 2)} AS score FROM s2),
s4 AS (SELECT *, CASE WHEN score >= 60 THEN 'ENTER' WHEN score < 30 THEN 'EXIT' ELSE 'HOLD' END AS sig FROM s3),
s5 AS (SELECT *, CASE WHEN sig = 'ENTER' AND row_number() OVER (PARTITION BY date, sig ORDER BY score DESC, ticker) > 4 THEN 'HOLD' ELSE sig END AS signal FROM s4),
sig AS (SELECT date, ticker, reg AS market_regime, technical_score, score, signal, CASE WHEN alpha >= 0.02e0 THEN 'rising' WHEN alpha <= -0.01e0 THEN 'declining' ELSE 'stable' END AS conviction,
  concat('Sec', CAST(CAST(split_part(ticker, '#', 2) AS INT) % 5 AS VARCHAR)) AS sector, CASE signal WHEN 'ENTER' THEN 'BUY' WHEN 'EXIT' THEN 'SELL' ELSE 'HOLD' END AS rating, CASE WHEN signal = 'ENTER' THEN 'buy' ELSE 'universe' END AS bucket FROM s5)"""


def brand_sectors(t):
    number = F.element_at(F.split("p_brand", "#"), 2).cast("int")
    return t.part.select(F.col("p_brand").alias("ticker"), F.concat(F.lit("Sec"), (number % 5).cast("string")).alias("sector")).distinct()


def brand_signals(t):
    return I.synthetic_signals(t.brand_bars.select("ticker", "date", "alpha"), t.brand_bars, brand_sectors(t), t.macro_snapshots, top_n=4)


@query("synthetic_signals", f"WITH {SIGNALS} SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM sig")
def _(t):
    return brand_signals(t)


# --- model scoring --------------------------------------------------------------

NAMES = ["atr_14_pct", "rsi_14", "momentum_20d", "breadth"]
WEIGHTS = {"atr_14_pct": 0.5, "rsi_14": 0.001, "momentum_20d": -0.002, "breadth": 0.01}


def score_sql(zero: tuple[str, ...] = ()) -> str:
    v = {n: "0e0" if n in zero else n for n in NAMES}
    cond = " AND ".join(f"{n} IS NOT NULL" for n in NAMES if n not in zero)
    expr = "0.01e0" + "".join(f" + {v[n]} * {w}e0" for n, w in WEIGHTS.items())
    return f"SELECT ticker, date, {r(expr)} AS alpha FROM {{features}} WHERE {cond}"


@query("model_scores", score_sql().replace("date,", "CAST(date AS VARCHAR) AS date,", 1))
def _(t):
    """Rows with every feature known, scored by a linear model."""
    return I.linear_scores(I.scoreable_rows(t.features, NAMES, order="last_id"), WEIGHTS, 0.01)


@query("model_scores_zeroed", score_sql(("momentum_20d",)).replace("date,", "CAST(date AS VARCHAR) AS date,", 1))
def _(t):
    """A zeroed feature lets rows in that lacked it."""
    return I.linear_scores(I.scoreable_rows(t.features, NAMES, zero=["momentum_20d"]), WEIGHTS, 0.01)


@query("model_scores_batched", score_sql().replace("date,", "CAST(date AS VARCHAR) AS date,", 1))
def _(t):
    """The same model behind a vectorised predict call on Arrow batches."""
    from assay.functions.scalars import rnd
    w = [WEIGHTS[n] for n in NAMES]
    out = I.batch_scores(I.scoreable_rows(t.features, NAMES), NAMES, lambda x: x @ w + 0.01)
    return out.select("ticker", "date", rnd("alpha", 6).alias("alpha"))
