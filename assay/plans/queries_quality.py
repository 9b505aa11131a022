"""Signal quality queries with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.operators import quality as Q
from assay.plans.registry import query
from assay.plans.views import r


def wilson(s: str, n: str) -> tuple[str, str]:
    s, n = f"CAST({s} AS DOUBLE)", f"CAST({n} AS DOUBLE)"
    z2 = "3.8416e0"
    p = f"({s} / {n})"
    den = f"(1 + {z2} / {n})"
    mid = f"(({p} + {z2} / (2 * {n})) / {den})"
    spread = f"(1.96e0 * sqrt({p} * (1 - {p}) / {n} + {z2} / (4 * {n} * {n})) / {den})"
    return (
        f"CASE WHEN {n} > 0 THEN {r(f'greatest(0e0, {mid} - {spread})', 4)} END",
        f"CASE WHEN {n} > 0 THEN {r(f'least(1e0, {mid} + {spread})', 4)} END",
    )


def slice_sql() -> str:
    out = []
    for h in Q.HORIZONS:
        b = f"beat_spy_{h}"
        lo, hi = wilson(f"coalesce(sum({b}), 0)", f"count({b})")
        out += [
            f"{r(f'avg({b})')} AS accuracy_{h}", f"{lo} AS ci_low_{h}", f"{hi} AS ci_high_{h}",
            f"{r(f'avg(CASE WHEN {b} IS NOT NULL THEN return_{h} - spy_{h}_return END)')} AS avg_alpha_{h}",
            f"count({b}) AS n_{h}",
        ]
    out += [
        f"{r('avg(beat_spy_10d)', 4)} AS precision_10d",
        "CAST(coalesce(sum(beat_spy_10d), 0) AS BIGINT) AS tp_10d",
        "CAST(count(beat_spy_10d) - coalesce(sum(beat_spy_10d), 0) AS BIGINT) AS fp_10d",
    ]
    return ", ".join(out)


SLICE = slice_sql()


def norm_cdf_sql(z: str) -> str:
    x = f"(abs({z}) / sqrt(2e0))"
    t = f"(1e0 / (1e0 + 0.3275911e0 * {x}))"
    poly = "0e0"
    for a in ("1.061405429e0", "-1.453152027e0", "1.421413741e0", "-0.284496736e0", "0.254829592e0"):
        poly = f"({t} * ({a} + {poly}))"
    erf = f"(1e0 - {poly} * exp(-{x} * {x}))"
    return f"(0.5e0 * (1e0 + CASE WHEN {z} < 0 THEN -{erf} ELSE {erf} END))"


def bh_sql(rows: str, p: str, flag: str, alpha: str = "0.05e0") -> str:
    """SELECT * plus a significance flag over the rows of a sub-select."""
    return f"""
    SELECT *, coalesce(k <= max(CASE WHEN {p} <= k * 1e0 / m * {alpha} THEN k END) OVER (), false) AS {flag}
    FROM (SELECT *, CASE WHEN {p} IS NOT NULL THEN row_number() OVER (ORDER BY {p} ASC NULLS LAST) END AS k,
                 count({p}) OVER () AS m FROM ({rows}))"""


@query("signal_quality_overall", f"""
SELECT 'ok' AS status, {SLICE} FROM {{scored_signals}}""")
def _(t):
    return Q.overall_accuracy(t.scored_signals)


@query("signal_quality_gate", """
SELECT CASE WHEN count(beat_spy_10d) >= 1000000000 THEN 'ok' ELSE 'insufficient_data' END AS status,
       count(beat_spy_5d) AS n_5d, count(beat_spy_10d) AS n_10d, count(beat_spy_30d) AS n_30d FROM {scored_signals}""")
def _(t):
    """The sample gate when it is not reached: status and counts only."""
    return Q.overall_accuracy(t.scored_signals, min_samples=10**9).select("status", "n_5d", "n_10d", "n_30d")


_BUCKET = ("CASE WHEN score >= 60 AND score < 70 THEN '60-70' WHEN score >= 70 AND score < 80 THEN '70-80' "
           "WHEN score >= 80 AND score < 90 THEN '80-90' WHEN score >= 90 AND score < 101 THEN '90+' END")
_BUCKET_ROWS = f"""
SELECT *, 2e0 * (1e0 - {norm_cdf_sql('(abs(accuracy_10d - 0.5e0) / greatest(sqrt(0.25e0 / n_10d), 1e-10))')}) AS p
FROM (SELECT {_BUCKET} AS bucket, {SLICE} FROM {{scored_signals}} GROUP BY 1) WHERE bucket IS NOT NULL AND n_10d > 0"""


@query("signal_quality_by_bucket", f"""
SELECT * EXCLUDE (p, k, m, sig), n_10d < 20 AS exploratory, NOT sig AS fdr_exploratory
FROM ({bh_sql(_BUCKET_ROWS, 'p', 'sig')})""")
def _(t):
    return Q.accuracy_by_bucket(t.scored_signals)


@query("signal_quality_by_conviction", f"""
SELECT conviction, {SLICE} FROM {{scored_signals}} WHERE conviction IS NOT NULL GROUP BY 1 HAVING count(beat_spy_10d) > 0""")
def _(t):
    return Q.accuracy_by_field(t.scored_signals, "conviction")


@query("signal_quality_by_sector", f"""
SELECT d.sector, {SLICE} FROM {{scored_signals}} s
JOIN (SELECT DISTINCT ticker, sector FROM {{universe_returns}} WHERE sector IS NOT NULL AND sector <> '') d ON s.symbol = d.ticker
GROUP BY 1 HAVING count(beat_spy_10d) > 0""")
def _(t):
    return Q.accuracy_by_field(Q.with_sector(t.scored_signals.drop("sector"), t.universe_returns), "sector")


@query("signals_with_sector", """
SELECT s.symbol, d.sector, count(*) AS n, count(CASE WHEN d.sector IS NULL THEN 1 END) AS unmapped
FROM {scored_signals} s LEFT JOIN (SELECT DISTINCT ticker, sector FROM {universe_returns}
  WHERE sector IS NOT NULL AND sector <> '' AND sector <> 'ASIA') d ON s.symbol = d.ticker GROUP BY 1, 2""")
def _(t):
    """Scan of scored signals enriched from the sector dimension, counted per symbol."""
    known = t.universe_returns.filter("sector <> 'ASIA'")
    return (
        Q.with_sector(t.scored_signals.drop("sector"), known).groupBy("symbol", "sector")
        .agg(F.count("*").alias("n"), F.count_if(F.col("sector").isNull()).alias("unmapped"))
    )


@query("signals_with_regime", """
SELECT s.score_date, m.market_regime, count(*) AS n FROM {scored_signals} s
LEFT JOIN {macro_snapshots} m ON s.score_date = m.date GROUP BY 1, 2""".replace("s.score_date,", "CAST(s.score_date AS VARCHAR) AS score_date,"))
def _(t):
    return Q.with_regime(t.scored_signals, t.macro_snapshots).groupBy("score_date", "market_regime").agg(
        F.count("*").alias("n"))


@query("signal_quality_by_regime", f"""
SELECT m.market_regime, {SLICE} FROM {{scored_signals}} s JOIN {{macro_snapshots}} m ON s.score_date = m.date
GROUP BY 1 HAVING count(beat_spy_10d) > 0""")
def _(t):
    return Q.accuracy_by_regime(t.scored_signals, t.macro_snapshots)


_THRESHOLDS = f"""
SELECT t.threshold, {SLICE} FROM {{scored_signals}} s
JOIN (VALUES (60e0), (65e0), (70e0), (72e0), (75e0), (78e0), (80e0), (85e0), (90e0)) t(threshold) ON s.score >= t.threshold
GROUP BY 1 HAVING count(beat_spy_10d) >= 30"""


@query("accuracy_by_threshold", _THRESHOLDS)
def _(t):
    return Q.accuracy_by_threshold(t.scored_signals)


@query("optimal_threshold", f"SELECT * FROM ({_THRESHOLDS}) ORDER BY accuracy_10d DESC, threshold LIMIT 1")
def _(t):
    return Q.optimal_threshold(t.scored_signals)


_ALPHA = " UNION ALL ".join(
    f"SELECT '{h}' AS horizon, return_{h} - spy_{h}_return AS alpha FROM {{scored_signals}} WHERE return_{h} IS NOT NULL AND spy_{h}_return IS NOT NULL"
    for h in Q.HORIZONS)
ALPHA_SPINE = "(VALUES (0, '<-5%', -1e300, -5e0), (1, '-5% to -2%', -5e0, -2e0), (2, '-2% to 0%', -2e0, 0e0), (3, '0% to +2%', 0e0, 2e0), (4, '+2% to +5%', 2e0, 5e0), (5, '>+5%', 5e0, 1e300)) b(bucket_no, bucket, lo, hi)"


@query("alpha_distribution", f"""
WITH a AS ({_ALPHA}), n AS (SELECT horizon, count(*) AS n FROM a GROUP BY 1)
SELECT n.horizon, b.bucket_no, b.bucket, count(a.alpha) AS count, {r('count(a.alpha) * 1e0 / max(n.n)', 4)} AS pct,
       {r('avg(a.alpha)', 4)} AS avg_alpha
FROM n CROSS JOIN {ALPHA_SPINE} LEFT JOIN a ON a.horizon = n.horizon AND a.alpha >= b.lo AND a.alpha < b.hi
GROUP BY 1, 2, 3""")
def _(t):
    return Q.alpha_distribution(t.scored_signals)


@query("alpha_summary", f"""
WITH a AS ({_ALPHA})
SELECT horizon, count(*) AS n, {r('avg(alpha)', 4)} AS avg_alpha, {r('median(alpha)', 4)} AS median_alpha,
       {r('stddev_samp(alpha)', 4)} AS std_alpha, {r('skewness(alpha)', 4)} AS skew,
       {r('avg(CASE WHEN alpha > 0 THEN 1e0 ELSE 0e0 END)', 4)} AS pct_positive FROM a GROUP BY 1""")
def _(t):
    return Q.alpha_summary(t.scored_signals)


@query("score_calibration", f"""
WITH sub AS (
  SELECT s.*, m.market_regime, s.return_10d - s.spy_10d_return AS alpha FROM {{scored_signals}} s
  LEFT JOIN {{macro_snapshots}} m ON s.score_date = m.date
  WHERE score IS NOT NULL AND return_10d IS NOT NULL AND spy_10d_return IS NOT NULL),
q AS (SELECT list_sort(list_distinct(quantile_cont(score, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM sub),
b AS (SELECT sub.*, greatest(len(list_filter(q.e, lambda x: x < sub.score)), 1) AS bin, q.e FROM sub, q),
s AS (SELECT bin, max(e[bin]) AS score_low, max(e[bin + 1]) AS score_high, count(*) AS n, {r('avg(score)', 4)} AS avg_score,
        {r('avg(alpha)', 2)} AS avg_alpha, {r('avg(CASE WHEN alpha > 0 THEN 1e0 ELSE 0e0 END)', 4)} AS beat_spy_pct,
        CAST(min(score_date) AS VARCHAR) AS first_date, CAST(max(score_date) AS VARCHAR) AS last_date,
        count(DISTINCT score_date) AS n_unique_dates, count(DISTINCT symbol) AS n_unique_tickers FROM b GROUP BY bin HAVING count(*) >= 3),
tops AS (SELECT bin, string_agg(lbl, ', ' ORDER BY rk) AS top_sectors FROM (
   SELECT bin, concat(rk, ':', sector, '=', c) AS lbl, rk FROM (SELECT bin, sector, count(*) AS c, row_number() OVER (PARTITION BY bin ORDER BY count(*) DESC, sector) AS rk FROM b WHERE sector IS NOT NULL GROUP BY bin, sector)) WHERE rk <= 3 GROUP BY bin),
reg AS (SELECT bin, string_agg(lbl, ', ' ORDER BY rk) AS regime_breakdown FROM (
   SELECT bin, concat(rk, ':', market_regime, '=', c) AS lbl, rk FROM (SELECT bin, market_regime, count(*) AS c, row_number() OVER (PARTITION BY bin ORDER BY count(*) DESC, market_regime) AS rk FROM b WHERE market_regime IS NOT NULL GROUP BY bin, market_regime)) GROUP BY bin)
SELECT s.*, top_sectors, regime_breakdown, NOT max(falls) OVER () AS monotonic
FROM (SELECT s.*, coalesce(avg_alpha < lag(avg_alpha) OVER (ORDER BY bin), false) AS falls FROM s) s LEFT JOIN tops USING (bin) LEFT JOIN reg USING (bin)
""".replace("SELECT s.*, top_sectors", "SELECT s.* EXCLUDE (falls), top_sectors"))
def _(t):
    return Q.score_calibration(t.scored_signals, t.macro_snapshots)


def pearson_sql(x: str, y: str, least: int) -> str:
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    px, py = f"CASE WHEN {both} THEN {x} END", f"CASE WHEN {both} THEN {y} END"
    return (f"CASE WHEN count({px}) >= {least} AND stddev_samp({px}) > 1e-9 AND stddev_samp({py}) > 1e-9 "
            f"THEN covar_samp({px}, {py}) / (stddev_samp({px}) * stddev_samp({py})) END")


_NET = "(coalesce(TRY_CAST(p_up AS DOUBLE), 0) - coalesce(p_down, 0))"
_PAIRS = [(s, t, c) for s, c in (("quant", "quant_score"), ("qual", "qual_score"))
          for t in ("beat_spy_10d", "beat_spy_30d", "return_10d", "return_30d")]
_PAIRS += [("predictor", t, _NET) for t in ("beat_spy_10d", "beat_spy_30d")]
_ATTR = " UNION ALL ".join(
    f"SELECT count(*) AS rows_analyzed, '{s}' AS source, '{t}' AS target, {r(pearson_sql(c, t, 10))} AS r, "
    f"count(CASE WHEN {c} IS NOT NULL AND {t} IS NOT NULL THEN 1 END) AS n FROM z" for s, t, c in _PAIRS)


@query("sub_score_correlations", f"""
WITH z AS (SELECT * FROM {{scored_signals}} WHERE beat_spy_10d IS NOT NULL), x AS ({_ATTR})
SELECT *, CASE WHEN source <> 'predictor' THEN row_number() OVER (PARTITION BY target, source = 'predictor' ORDER BY coalesce(r, 0) DESC, source) END AS rank
FROM x WHERE rows_analyzed >= 100""")
def _(t):
    return Q.sub_score_attribution(t.scored_signals, p_values=False)


_COS = lambda lo, hi: (f"(({hi} - {lo}) / 200 / 3 * list_sum(list_transform(range(0, 201), lambda k: (CASE WHEN k = 0 OR k = 200 THEN 1e0 WHEN k % 2 = 1 THEN 4e0 ELSE 2e0 END)"  # noqa: E731
                       f" * pow(greatest(cos({lo} + k * ({hi} - {lo}) / 200), 0e0), n - 3))))")


@query("sub_score_attribution", f"""
WITH z AS (SELECT * FROM {{scored_signals}} WHERE beat_spy_10d IS NOT NULL), x AS ({_ATTR}),
k AS (SELECT *, CASE WHEN source <> 'predictor' THEN row_number() OVER (PARTITION BY target, source = 'predictor' ORDER BY coalesce(r, 0) DESC, source) END AS rank FROM x WHERE rows_analyzed >= 100),
a AS (SELECT *, asin(least(abs(r), 1e0)) AS lo, least(pi() / 2, sqrt(60e0 / (n - 2))) AS u0, least(pi() / 2, sqrt(asin(least(abs(r), 1e0)) * asin(least(abs(r), 1e0)) + 60e0 / (n - 2))) AS u1 FROM k),
p AS (SELECT rows_analyzed, source, target, r, n, rank, CASE WHEN r IS NOT NULL AND n >= 3 THEN CASE WHEN abs(r) >= 1 THEN 0e0 ELSE {r(f"least(1e0, {_COS('lo', 'u1')} / {_COS('0e0', 'u0')})", 4)} END END AS p_value FROM a),
o AS (SELECT *, row_number() OVER (ORDER BY p_value NULLS LAST) AS j, count(p_value) OVER () AS m FROM p)
SELECT rows_analyzed, source, target, r, n, rank, p_value, coalesce(p_value IS NOT NULL AND j <= max(CASE WHEN p_value <= j * 1e0 / m * 0.05e0 THEN j END) OVER (), false) AS fdr_significant FROM o""")
def _(t):
    """With Student-t p-values and the step-up correction."""
    return Q.sub_score_attribution(t.scored_signals)


@query("sub_score_struct_attribution", f"""
WITH z AS (SELECT *, quant_score AS qs FROM {{scored_signals}} WHERE beat_spy_10d IS NOT NULL), x AS ({_ATTR})
SELECT source, target, r, n FROM x WHERE source <> 'predictor'""")
def _(t):
    """Sub-scores given as one struct column instead of two plain ones."""
    nested = t.scored_signals.withColumn(
        "sub_scores", F.struct(F.col("quant_score").alias("quant"), F.col("qual_score").alias("qual"))
    ).drop("quant_score", "qual_score", "p_up")
    return Q.sub_score_attribution(nested, p_values=False).select("source", "target", "r", "n")


_lo, _hi = wilson("sum(correct_5d)", "count(correct_5d)")


@query("predictor_hit_rate", f"""
SELECT count(correct_5d) AS n, {r('avg(correct_5d)', 4)} AS hit_rate, {_lo} AS ci_low, {_hi} AS ci_high
FROM {{scored_signals}} WHERE beat_spy_10d IS NOT NULL""")
def _(t):
    return Q.predictor_hit_rate(t.scored_signals)


@query("data_accumulation", f"""
SELECT count(*) AS total_rows, CAST(min(score_date) AS VARCHAR) AS first_date, CAST(max(score_date) AS VARCHAR) AS last_date,
  count(DISTINCT score_date) AS distinct_dates,
  {', '.join(f"count(beat_spy_{h}) AS resolved_{h}, {r(f'avg(beat_spy_{h})', 4)} AS accuracy_{h}" for h in Q.HORIZONS)}
FROM {{scored_signals}}""")
def _(t):
    return Q.accumulation(t.scored_signals)


@query("stale_outcomes", """
SELECT count(CASE WHEN return_5d IS NULL AND score_date <= DATE '2001-12-01' - 10 THEN 1 END) AS stale_5d,
       count(CASE WHEN return_10d IS NULL AND score_date <= DATE '2001-12-01' - 14 THEN 1 END) AS stale_10d,
       count(CASE WHEN return_30d IS NULL AND score_date <= DATE '2001-12-01' - 45 THEN 1 END) AS stale_30d FROM {scored_signals}""")
def _(t):
    return Q.stale_rows(t.scored_signals, "2001-12-01")
