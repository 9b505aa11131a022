"""Single rules and small steps run over whole tables, with their SQL oracles."""

from __future__ import annotations


from pyspark.sql import functions as F

from assay.functions import scalars as S
from assay.functions.scalars import rnd
from assay.operators import decisions as D
from assay.operators import prices as P
from assay.operators.asof import calendar
from assay.plans.queries_documents import REC, parsed
from assay.plans.queries_market import _BF, _FFILL
from assay.plans.queries_quality import norm_cdf_sql, wilson
from assay.plans.registry import query
from assay.plans.views import r
from assay.sources import documents as DOC
from assay.sources import tables as TB


@query("net_signals", f"SELECT symbol, CAST(score_date AS VARCHAR) AS score_date, p_up, p_down, {r('coalesce(TRY_CAST(p_up AS DOUBLE), 0) - coalesce(p_down, 0)')} AS net FROM {{scored_signals}}")
def _(t):
    """p_up is text here and partly not a number."""
    return t.scored_signals.select("symbol", "score_date", "p_up", "p_down", rnd(S.net_signal("p_up", "p_down"), 6).alias("net"))


_lo, _hi = wilson("sum(beat_spy_10d)", "count(beat_spy_10d)")
_Z = "(abs(avg(beat_spy_10d) - 0.5e0) / greatest(sqrt(0.25e0 / count(beat_spy_10d)), 1e-10))"


@query("symbol_accuracy_tests", f"SELECT symbol, count(beat_spy_10d) AS n, {_lo} AS ci_low, {_hi} AS ci_high, {r(f'2e0 * (1e0 - {norm_cdf_sql(_Z)})')} AS p_value FROM {{scored_signals}} GROUP BY 1 HAVING count(beat_spy_10d) > 0")
def _(t):
    """Wilson interval and z-test of every symbol's hit rate."""
    b = F.col("beat_spy_10d")
    d = t.scored_signals.groupBy("symbol").agg(F.count(b).alias("n"), F.sum(b).alias("w"), F.avg(b).alias("a")).filter("n > 0")
    lo, hi = S.wilson_bounds("w", "n")
    return d.select("symbol", "n", lo.alias("ci_low"), hi.alias("ci_high"), rnd(S.proportion_p_value("a", "n"), 6).alias("p_value"))


_CL = lambda x: f"greatest(0e0, least(100e0, {x}))"
_V = "return_10d"


@query("grade_scales", f"""SELECT symbol, CAST(score_date AS VARCHAR) AS score_date, {_V}, {r(_CL(f'30 + ({_V} / 10 - 0.1e0) / 0.4e0 * 65'), 4)} AS pct_grade, {r(_CL(f'CASE WHEN {_V} <= 0 THEN 40 * (1 + {_V} / 2e0) ELSE 40 + 60 * ({_V} / 3e0) END'), 4)} AS lift_grade,
  {r(_CL(f'20 + {_V} / 40 * 700'), 4)} AS ic_grade, {r(f'CASE WHEN {_V} / 4 <= 0 THEN 0e0 WHEN {_V} / 4 >= 1 THEN 100e0 WHEN {_V} / 4 <= 0.75e0 THEN 80 * ({_V} / 4 / 0.75e0) ELSE 80 + 20 * (({_V} / 4 - 0.75e0) / 0.25e0) END', 4)} AS ratio_grade FROM {{scored_signals}} WHERE {_V} IS NOT NULL""")
def _(t):
    """The four grade scales over a column of every sign and size."""
    v = F.col(_V)
    return t.scored_signals.filter(v.isNotNull()).select(
        "symbol", "score_date", _V, rnd(S.pct_grade(v / 10, 0.1, 0.5), 4).alias("pct_grade"), rnd(S.lift_grade(v, -2.0, 3.0), 4).alias("lift_grade"),
        rnd(S.ic_grade(v / 40), 4).alias("ic_grade"), rnd(S.ratio_grade(v / 4, 0.75), 4).alias("ratio_grade"))


@query("signal_ages", "SELECT ticker, CAST(date AS VARCHAR) AS date, CAST(sd AS VARCHAR) AS signal_date, date_diff('day', sd, date) AS age_days FROM (SELECT ticker, date, lag(date) OVER (PARTITION BY ticker ORDER BY date) AS sd FROM {bars}) WHERE sd IS NOT NULL")
def _(t):
    """Calendar days since the ticker's previous row."""
    from pyspark.sql import Window
    sd = F.lag("date").over(Window.partitionBy("ticker").orderBy("date"))
    d = t.bars.select("ticker", "date", sd.alias("signal_date")).filter("signal_date IS NOT NULL")
    return d.withColumn("age_days", S.signal_age_days("date", "signal_date"))


@query("conviction_labels", "SELECT ticker, CASE WHEN alpha >= 0.02e0 THEN 'rising' WHEN alpha <= -0.01e0 THEN 'declining' ELSE 'stable' END AS conviction, count(*) AS n FROM {brand_bars} GROUP BY 1, 2")
def _(t):
    return t.brand_bars.groupBy("ticker", S.conviction_of("alpha").alias("conviction")).agg(F.count("*").alias("n"))


_MA = "CASE WHEN x >= 5 THEN least(100e0, 80 + (x - 5) * (20e0 / 15)) WHEN x >= 0 THEN 50 + x * 6 WHEN x > -5 THEN 50 + x * 4 ELSE greatest(0e0, 30 - (abs(x) - 5) * 1.5e0) END"


@query("technical_score_pieces", f"""SELECT ticker, CAST(date AS VARCHAR) AS date, {r('CASE WHEN rsi_14 >= 70 THEN 0e0 WHEN rsi_14 <= 30 THEN 100e0 ELSE 100 * (70 - rsi_14) / 40e0 END', 4)} AS rsi_neutral, {r('CASE WHEN rsi_14 >= 80 THEN 0e0 WHEN rsi_14 <= 30 THEN 100e0 ELSE 100 * (80 - rsi_14) / 50e0 END', 4)} AS rsi_bull,
  {r('CASE WHEN rsi_14 >= 70 THEN 0e0 WHEN rsi_14 <= 40 THEN 65e0 ELSE 65 * (70 - rsi_14) / 30e0 END', 4)} AS rsi_bear, {r(f'CASE WHEN x IS NULL THEN 50e0 ELSE {_MA} END', 4)} AS average_score, {r('CASE WHEN x IS NULL THEN 50e0 ELSE greatest(0e0, least(100e0, 50 + x * 3)) END', 4)} AS momentum_score FROM (SELECT *, momentum_20d AS x FROM {{features}})""")
def _(t):
    rsi = lambda g: rnd(S.rsi_score("rsi_14", F.lit(g)), 4)
    return t.features.select(
        "ticker", "date", rsi("neutral").alias("rsi_neutral"), rsi("bull").alias("rsi_bull"), rsi("bear").alias("rsi_bear"),
        rnd(S.average_distance_score("momentum_20d"), 4).alias("average_score"), rnd(S.momentum_score("momentum_20d"), 4).alias("momentum_score"))


@query("candidate_features", """SELECT b.ticker, CAST(b.date AS VARCHAR) AS date, b.close, l.atr AS atr_pct, l.coverage, p.prediction_confidence AS confidence, p.p_up, coalesce(p.predicted_direction = 'DOWN', false) AS model_veto FROM {bars} b
 LEFT JOIN (SELECT ticker, CASE WHEN atr_14_pct > 0 THEN atr_14_pct END AS atr, floor((CASE WHEN atr_14_pct IS NULL THEN 0 ELSE 1 END + CASE WHEN momentum_20d IS NULL THEN 0 ELSE 1 END) / 2e0 * 1e4 + 0.5000001e0) / 1e4 AS coverage
   FROM (SELECT replace(ticker, 'U', 'S') AS ticker, date, atr_14_pct, momentum_20d FROM {features}) QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1) l USING (ticker)
 LEFT JOIN {predictor_outcomes} p ON p.symbol = b.ticker AND p.prediction_date = b.date""")
def _(t):
    """Rows of a day with the last ATR and coverage of their ticker and their prediction."""
    f = t.features.select(F.replace("ticker", F.lit("U"), F.lit("S")).alias("ticker"), "date", "atr_14_pct", "momentum_20d")
    preds = t.predictor_outcomes.withColumnsRenamed({"symbol": "ticker", "prediction_date": "date"})
    return D.candidate_rows(t.bars.select("ticker", "date", "close"), P.latest_features(f), preds)


_DAYS = "(SELECT date, row_number() OVER (ORDER BY date) - 1 AS pos FROM (SELECT DISTINCT eval_date AS date FROM {cio_evaluations}))"
_TK = "(SELECT DISTINCT ticker FROM {cio_evaluations} WHERE cio_decision = 'ADVANCE')"


@query("signal_price_matrix", f"""WITH g AS (SELECT s.ticker, c.date, c.pos, b.close FROM {_TK} s CROSS JOIN {_DAYS} c LEFT JOIN {{bars}} b ON b.ticker = s.ticker AND b.date = c.date), f AS (SELECT *, {_FFILL} AS f FROM g)
 SELECT ticker, CAST(date AS VARCHAR) AS date, price FROM (SELECT *, {_BF} AS price FROM f) WHERE price IS NOT NULL""")
def _(t):
    """Filled closes of the tickers the signals name, on the signals' dates."""
    late = t.cio_evaluations
    wanted = late.filter("cio_decision = 'ADVANCE'").select("ticker").distinct()
    bars = t.bars.join(wanted, "ticker", "left_semi")
    return P.price_matrix(bars, calendar(late, "eval_date")).drop("filled")


@query("alert_history", "SELECT CAST(date AS VARCHAR) AS date, n_alerts FROM (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n_alerts FROM {orders} WHERE o_orderpriority = '1-URGENT' GROUP BY 1)")
def _(t):
    """An alert row per run date appended to those before it; a rerun changes nothing."""
    daily = t.orders.filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count("*").alias("n_alerts"))
    new = daily.filter("date >= DATE '2001-06-01'")
    first = TB.append_once(daily.filter("date < DATE '2001-06-01'"), new, "date")
    return TB.append_once(first, new, "date")


@query("promotion_baseline", """SELECT CAST(run_date AS VARCHAR) AS run_date, accuracy_10d, n_promoted FROM (SELECT score_date AS run_date, floor(avg(beat_spy_10d) * 1e6 + 0.5000001e0) / 1e6 AS accuracy_10d, count(CASE WHEN score > 95 THEN 1 END) AS n_promoted FROM {scored_signals} GROUP BY 1 HAVING count(CASE WHEN score > 95 THEN 1 END) > 0) ORDER BY run_date DESC LIMIT 1""")
def _(t):
    """Metrics of the latest run that promoted something."""
    runs = t.scored_signals.groupBy(F.col("score_date").alias("run_date")).agg(
        rnd(F.avg("beat_spy_10d"), 6).alias("accuracy_10d"), F.count_if(F.col("score") > 95).alias("n_promoted"))
    return TB.latest_row(runs.filter("n_promoted > 0"), "run_date")


@query("component_history", f"""SELECT CAST(run_date AS VARCHAR) AS run_date, component, {r('avg(grade)', 4)} AS grade, count(*) AS n FROM (SELECT run_date, m AS component, TRY_CAST(json_extract_string(body, concat('$.', m, '.grade')) AS DOUBLE) AS grade FROM {{grade_docs}}, (VALUES ('research'), ('predictor'), ('executor')) v(m)) GROUP BY 1, 2""")
def _(t):
    """Module grades of the documents by run date."""
    g = DOC.grade_rows(t.grade_docs).filter(~F.contains("component", F.lit(".")))
    return g.join(t.grade_docs.select("doc_id", "run_date"), "doc_id").groupBy("run_date", "component").agg(
        rnd(F.avg("grade"), 4).alias("grade"), F.count("*").alias("n"))


@query("entry_candidates_by_date", f"SELECT CAST(date AS VARCHAR) AS date, count(*) AS n, count(DISTINCT ticker) AS n_tickers, {r('max(score)', 2)} AS best FROM {REC} WHERE bucket = 'buy' GROUP BY 1")
def _(t):
    rec = DOC.flat_records(parsed(t)).filter("bucket = 'buy'")
    names = rec.select("date", "ticker").distinct().groupBy("date").agg(F.count("*").alias("n_tickers"))
    return rec.groupBy("date").agg(F.count("*").alias("n"), rnd(F.max("score"), 2).alias("best")).join(names, "date")


@query("pick_overlap", """SELECT CAST(eval_date AS VARCHAR) AS date, count(CASE WHEN a AND b THEN 1 END) AS overlap, count(CASE WHEN a THEN 1 END) AS n_advance, count(CASE WHEN b THEN 1 END) AS n_team FROM (
  SELECT coalesce(c.eval_date, t.eval_date) AS eval_date, c.ticker IS NOT NULL AS a, t.ticker IS NOT NULL AS b FROM (SELECT DISTINCT ticker, eval_date FROM {cio_evaluations} WHERE cio_decision = 'ADVANCE') c FULL JOIN (SELECT DISTINCT ticker, eval_date FROM {team_candidates} WHERE team_recommended = 1) t ON c.ticker = t.ticker AND c.eval_date = t.eval_date) GROUP BY 1""")
def _(t):
    """Size of the overlap of two pick sets per date."""
    key = lambda df, n: df.select("ticker", "eval_date").distinct().withColumn(n, F.lit(1))
    a = key(t.cio_evaluations.filter("cio_decision = 'ADVANCE'"), "a")
    b = key(t.team_candidates.filter("team_recommended = 1"), "b")
    return a.join(b, ["ticker", "eval_date"], "full").groupBy(F.col("eval_date").alias("date")).agg(
        F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("overlap"), F.count("a").alias("n_advance"), F.count("b").alias("n_team"))


@query("traded_pairs", "SELECT ticker, CAST(date AS VARCHAR) AS date, close, EXISTS (SELECT 1 FROM {trades} x WHERE x.ticker = b.ticker AND x.date = b.date) AS traded FROM {bars} b")
def _(t):
    """Membership of a (ticker, date) pair in the traded set."""
    keys = t.trades.select("ticker", "date").distinct().withColumn("__t", F.lit(True))
    d = t.bars.select("ticker", "date", "close").join(keys, ["ticker", "date"], "left")
    return d.withColumn("traded", F.coalesce("__t", F.lit(False))).drop("__t")


