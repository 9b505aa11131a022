"""Recommendation queries with their SQL oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from assay.functions.frames import with_scalars
from assay.functions.scalars import automatic_trials, random_trials_needed, rnd
from assay.operators import indicators as I
from assay.operators import lift as L
from assay.operators import portfolio as PF
from assay.operators import predictor as P
from assay.operators import recommend as R
from assay.operators import trades as TR
from assay.operators import variants as V
from assay.operators.asof import calendar
from assay.plans import queries_predictor as QP
from assay.plans.queries_documents import BOOST_ROWS, PARAMS, SCANNER_DEFAULTS, boost_rows
from assay.plans.queries_lift import CIO, RANKING, TEAM
from assay.plans.queries_market import NAMES
from assay.plans.queries_market import WEIGHTS as MODEL
from assay.plans.queries_portfolio import CASH, STATS, SWEEP, combo_stats, path_nav
from assay.plans.queries_quality import pearson_sql
from assay.plans.queries_trades import _ENT, _SCORE, ENTRY_TRIGGERS, category_sql
from assay.plans.registry import query
from assay.plans.views import r
from assay.sources import documents as DOC

# --- grids -------------------------------------------------------------------------

_VALUES = """(SELECT DISTINCT 'size' AS param, CAST(p_size AS BIGINT) AS value FROM {part} UNION SELECT DISTINCT 'lines', CAST(l_linenumber AS BIGINT) FROM {lineitem} UNION SELECT DISTINCT 'region', CAST(r_regionkey AS BIGINT) FROM {region})"""
_CURRENT = "(SELECT 'size' AS param, CAST(max(p_size) + 7 AS BIGINT) AS value FROM {part} UNION ALL SELECT 'lines', CAST(max(l_linenumber) AS BIGINT) FROM {lineitem} UNION ALL SELECT 'other', 1)"
_SEEDED = f"(SELECT * FROM {_VALUES} UNION SELECT * FROM {_CURRENT} WHERE param IN ('size', 'lines', 'region'))"
GRID = ["size", "lines", "region"]


def grid_values(t):
    one = lambda df, p, c: df.select(F.lit(p).alias("param"), F.col(c).cast("bigint").alias("value")).distinct()
    return one(t.part, "size", "p_size").unionByName(one(t.lineitem, "lines", "l_linenumber")).unionByName(one(t.region, "region", "r_regionkey"))


def current_values(t):
    top = lambda df, p, c, k: df.agg((F.max(c) + k).cast("bigint").alias("value")).select(F.lit(p).alias("param"), "value")
    return top(t.part, "size", "p_size", 7).unionByName(top(t.lineitem, "lines", "l_linenumber", 0)).unionByName(
        t.part.limit(1).select(F.lit("other").alias("param"), F.lit(1).cast("bigint").alias("value")))


@query("seeded_grid_values", f"SELECT * FROM {_SEEDED}")
def _(t):
    return R.seed_grid(grid_values(t), current_values(t))


_GRID = f"(SELECT a.value AS size, b.value AS lines, c.value AS region FROM (SELECT value FROM {_SEEDED} WHERE param = 'size') a, (SELECT value FROM {_SEEDED} WHERE param = 'lines') b, (SELECT value FROM {_SEEDED} WHERE param = 'region') c)"


def full_grid(t):
    return R.parameter_grid(R.seed_grid(grid_values(t), current_values(t)), GRID)


@query("parameter_grid", f"SELECT * FROM {_GRID}")
def _(t):
    return full_grid(t)


_DRAW = f"(SELECT *, md5(concat('42|', CAST(size AS VARCHAR), '|', CAST(lines AS VARCHAR), '|', CAST(region AS VARCHAR))) AS draw FROM {_GRID} ORDER BY draw LIMIT 400)"


@query("sampled_grid", f"SELECT * FROM {_DRAW}")
def _(t):
    return R.sampled_grid(full_grid(t), GRID, 400)


@query("sweep_coverage", f"SELECT *, {r('n_trials * 1e0 / n_grid', 4)} AS coverage, CASE WHEN n_trials < n_grid THEN 'random' ELSE 'grid' END AS mode, {r('1 - pow(0.95e0, n_trials)')} AS hit_probability FROM (SELECT (SELECT count(*) FROM {_GRID}) AS n_grid, (SELECT count(*) FROM {_DRAW}) AS n_trials)")
def _(t):
    g = full_grid(t)
    return R.sweep_coverage(g, R.sampled_grid(g, GRID, 400))


@query("trial_counts", """SELECT l_linenumber, count(*) AS n_grid, CAST(least(greatest(50, least(ceil(count(*) * 0.25e0), 400)), count(*)) AS BIGINT) AS auto_trials, CAST(ceil(ln(1 - 0.95e0) / ln(1 - 0.01e0 * l_linenumber)) AS BIGINT) AS needed FROM {lineitem} GROUP BY 1""")
def _(t):
    g = t.lineitem.groupBy("l_linenumber").agg(F.count("*").alias("n_grid"))
    return g.select("l_linenumber", "n_grid", automatic_trials("n_grid").cast("bigint").alias("auto_trials"),
                    random_trials_needed(0.01 * F.col("l_linenumber"), F.lit(0.95)).cast("bigint").alias("needed"))


# --- sweep --------------------------------------------------------------------------

STAT = ["combo_id", "status", "total_orders", "total_trades", "win_rate", "total_return", "sharpe_ratio", "max_drawdown", "calmar_ratio", "spy_return", "total_alpha"]
_SW = f"{SWEEP}, sw AS (SELECT c.*, {', '.join('s.' + c for c in STAT[1:])}, CASE WHEN s.sharpe_ratio IS NULL THEN 'no result' END AS error FROM {{sweep_combos}} c LEFT JOIN cs s USING (combo_id))"


def sweep(t):
    return R.sweep_results(t.sweep_combos, combo_stats(t).select(*STAT))


@query("sweep_results", f"WITH {_SW} SELECT * FROM sw")
def _(t):
    """One combination has no result and stays as an error row."""
    return sweep(t)


@query("sweep_top_rows", f"WITH {_SW} SELECT * FROM sw ORDER BY total_alpha DESC NULLS LAST, sharpe_ratio DESC NULLS LAST, combo_id LIMIT 10")
def _(t):
    return sweep(t).limit(10)


@query("sweep_completion", f"WITH {_SW} SELECT count(*) AS n_total, count(CASE WHEN error IS NULL THEN 1 END) AS n_valid, {r('count(CASE WHEN error IS NULL THEN 1 END) * 1e0 / count(*)', 4)} AS completion, count(CASE WHEN error IS NULL THEN 1 END) * 1e0 / count(*) < 0.5e0 AS low_completion FROM sw")
def _(t):
    return R.sweep_completion(sweep(t))


@query("best_parameters", f"WITH {_SW} SELECT combo_id, min_score, max_position_pct, atr_multiplier, time_decay_reduce_days, time_decay_exit_days, profit_take_pct FROM sw WHERE sharpe_ratio IS NOT NULL ORDER BY total_alpha DESC NULLS LAST, sharpe_ratio DESC NULLS LAST, combo_id LIMIT 1")
def _(t):
    return R.best_parameters(sweep(t)).select(*t.sweep_combos.columns)


CURRENT = {"min_score": 92.0, "max_position_pct": 0.03, "atr_multiplier": 2.5, "profit_take_pct": 0.02}
TUNED = ["min_score", "max_position_pct", "atr_multiplier", "time_decay_exit_days", "profit_take_pct"]
_D = " + ".join(f"coalesce(pow(({p} - {v}e0) / nullif(max({p}) OVER () - min({p}) OVER (), 0), 2), 0e0)" for p, v in CURRENT.items())
_RK = f"""{SWEEP}, r0 AS (SELECT *, {r('sharpe_ratio - 0.5e0 * abs(max_drawdown)', 8)} AS combined_score, {r(f'sqrt({_D})', 8)} AS distance FROM cs),
 rk AS (SELECT *, row_number() OVER (ORDER BY combined_score DESC, combo_id) AS "rank", row_number() OVER (ORDER BY distance, combined_score DESC, combo_id) AS nearness FROM r0)"""


def ranked(t):
    return R.ranked_combos(combo_stats(t), TUNED, CURRENT)


@query("ranked_combos", f'WITH {_RK} SELECT combo_id, combined_score, distance, "rank", nearness FROM rk')
def _(t):
    return ranked(t).select("combo_id", "combined_score", "distance", "rank", "nearness")


_REC = f"""{_RK}, rc AS (SELECT *, (best_sharpe - baseline_sharpe) / abs(nullif(baseline_sharpe, 0)) AS gain FROM (SELECT count(*) AS n_combos, max(total_trades) AS most_trades, {', '.join(f'max(CASE WHEN "rank" = 1 THEN {c} END) AS best_{n}, max(CASE WHEN nearness = 1 THEN {c} END) AS baseline_{n}' for c, n in (('combo_id', 'combo'), ('sharpe_ratio', 'sharpe'), ('total_alpha', 'alpha')))},
   max(CASE WHEN nearness = 1 THEN "rank" END) AS baseline_rank, max(CASE WHEN nearness = 1 THEN distance END) AS baseline_distance FROM rk)),
 re AS (SELECT * EXCLUDE (gain), {r('gain', 4)} AS improvement, CASE WHEN n_combos < 5 OR (SELECT count(sharpe_ratio) * 1e0 / count(*) < 0.5e0 FROM cs) THEN 'insufficient_data' WHEN most_trades < 50 THEN 'insufficient_trades' WHEN best_sharpe < 0 THEN 'negative_sharpe' WHEN gain < 0.1e0 THEN 'no_improvement' ELSE 'ok' END AS status FROM rc)"""


@query("combo_recommendation", f"WITH {_REC} SELECT * FROM re")
def _(t):
    return R.recommend_combo(ranked(t), R.sweep_completion(sweep(t)))


@query("closer_combos", f"WITH {_RK} SELECT count(CASE WHEN distance < (SELECT distance FROM rk WHERE nearness = 1) THEN 1 END) AS n_closer_combos FROM rk")
def _(t):
    return R.closer_combos(ranked(t))


@query("holdout_check", f"""WITH {_REC}, hp AS (SELECT nv.*, lag(nv.nav) OVER (ORDER BY nv.pos) AS prev2 FROM re JOIN {{sweep_combos}} sc ON sc.combo_id = re.best_combo JOIN {{paths}} p ON p.min_score = sc.min_score AND p.max_position_pct = sc.max_position_pct JOIN nv ON nv.combo_id = p.combo_id WHERE nv.pos >= floor(((SELECT max(pos) FROM cal) + 1) * 0.7e0)),
 hs AS (SELECT count(*) AS n, CASE WHEN count(x) >= 2 AND stddev_samp(x) > 1e-15 THEN avg(x) / stddev_samp(x) * sqrt(252e0) ELSE 0e0 END AS s FROM (SELECT CASE WHEN prev2 > 0 THEN nav / prev2 - 1 WHEN prev2 IS NOT NULL THEN 0e0 END AS x FROM hp))
 SELECT best_combo AS combo_id, n AS holdout_dates, {r('s', 4)} AS holdout_sharpe, {r('CASE WHEN best_sharpe < 0 THEN 0e0 ELSE s / best_sharpe END', 4)} AS holdout_ratio, best_sharpe >= 0 AND s / best_sharpe >= 0.5e0 AND s > 0 AS holdout_passed,
  CASE WHEN status <> 'ok' OR (best_sharpe >= 0 AND s / best_sharpe >= 0.5e0 AND s > 0) THEN status ELSE 'holdout_failed' END AS status FROM hs, re""")
def _(t):
    keys = ["min_score", "max_position_pct"]
    nav = t.sweep_combos.select("combo_id", *keys).join(t.paths.withColumnRenamed("combo_id", "path"), keys).join(
        path_nav(t).withColumnRenamed("combo_id", "path"), "path")
    return R.holdout_check(nav.select("combo_id", "date", "pos", "nav"), R.recommend_combo(ranked(t), R.sweep_completion(sweep(t))))


# --- weights --------------------------------------------------------------------------

TIES = ["score", "quant_score", "qual_score", "return_10d", "return_30d", "p_down", "p_up"]
_SPLIT = f"(SELECT *, row_number() OVER (ORDER BY score_date, symbol, {', '.join(f'{c} NULLS FIRST' for c in TIES)}) <= floor(count(*) OVER () * 0.7e0 + 1e-9) AS in_train FROM {{scored_signals}} WHERE beat_spy_10d IS NOT NULL)"


def split(t):
    """Split signals with the columns that some query of them reads; the others are not shuffled."""
    own = ["score_date", "symbol", *TIES, "score", *[f"{s}_score" for s in R.SUB_SCORES], "beat_spy_10d", "return_10d", *R.TARGETS]
    signals = t.scored_signals.filter("beat_spy_10d IS NOT NULL").select(*dict.fromkeys(own))
    return t.kept("time_split", lambda: R.time_split(signals, 0.7, "score_date", "symbol", TIES))


@query("time_ordered_split", f"SELECT in_train, count(*) AS n, CAST(min(score_date) AS VARCHAR) AS first_date, CAST(max(score_date) AS VARCHAR) AS last_date, {r('sum(score)', 3)} AS total_score, {r('sum(return_10d)', 3)} AS total_return FROM {_SPLIT} GROUP BY 1")
def _(t):
    return split(t).groupBy("in_train").agg(
        F.count("*").alias("n"), F.min("score_date").alias("first_date"), F.max("score_date").alias("last_date"),
        rnd(F.sum("score"), 3).alias("total_score"), rnd(F.sum("return_10d"), 3).alias("total_return"))


def _corr_sql() -> str:
    out = []
    for k, cond in (("train", "in_train"), ("test", "NOT in_train")):
        for s in R.SUB_SCORES:
            for t in R.TARGETS:
                x, y = f"(CASE WHEN {cond} THEN {s}_score END)", f"(CASE WHEN {cond} THEN {t} END)"
                out.append(f"{pearson_sql(x, y, 10)} AS {k}_{s}_{t}")
    return ", ".join(out)


CORR = f"(SELECT count(*) AS n, count(CASE WHEN in_train THEN 1 END) AS n_train, count(CASE WHEN NOT in_train THEN 1 END) AS n_test, {_corr_sql()} FROM {_SPLIT})"
_CC = [f"{k}_{s}_{t}" for k in ("train", "test") for s in R.SUB_SCORES for t in R.TARGETS]


@query("split_correlations", f"SELECT n, n_train, n_test, {', '.join(f'{r(c)} AS {c}' for c in _CC)} FROM {CORR}")
def _(t):
    return R.split_correlations(split(t)).select("n", "n_train", "n_test", *[rnd(c, 6).alias(c) for c in _CC])


def _z(c):
    return f"coalesce({c}, 0e0)"


_WX = {s: f"greatest(0e0, 0.5e0 * {_z(f'train_{s}_beat_spy_10d')} + 0.5e0 * {_z(f'train_{s}_beat_spy_30d')})" for s in R.SUB_SCORES}
_SZ = {k: "(" + " + ".join(f"0.5e0 * abs({_z(f'{k}_{s}_{t}')})" for s in R.SUB_SCORES for t in R.TARGETS) + ")" for k in ("train", "test")}
_CUR = {"quant": 0.6, "qual": 0.4}
_W1 = f"""(SELECT *, {r('0.6e0 * (1 - bl) + coalesce(wq / nullif(wq + wl, 0), 0.6e0) * bl', 3)} AS sq, {r('0.4e0 * (1 - bl) + coalesce(wl / nullif(wq + wl, 0), 0.4e0) * bl', 3)} AS sl FROM (
   SELECT *, {_WX['quant']} AS wq, {_WX['qual']} AS wl, least(0.5e0, 0.2e0 + 0.3e0 * (n_train / 500e0)) AS bl, coalesce(1 - {_SZ['test']} / nullif({_SZ['train']}, 0), 0e0) AS dg FROM {CORR}))"""
WEIGHTS = f"""(SELECT CASE WHEN n >= 30 AND n_train >= 30 AND n_test >= 10 THEN 'ok' ELSE 'insufficient_data' END AS status, n, n_train, n_test, CASE WHEN n >= 300 THEN 'high' WHEN n >= 100 THEN 'medium' ELSE 'low' END AS confidence,
  {r('bl', 3)} AS blend_factor, {r('sq / (sq + sl)', 3)} AS quant_weight, {r('sl / (sq + sl)', 3)} AS qual_weight, {r('dg', 4)} AS oos_degradation, dg < 0.2e0 AS oos_passed, {r(f"{r('sq / (sq + sl)', 3)} - 0.6e0", 3)} AS quant_change, {r(f"{r('sl / (sq + sl)', 3)} - 0.4e0", 3)} AS qual_change FROM {_W1})"""


def weights(t):
    return R.suggest_weights(R.split_correlations(split(t)), _CUR)


@query("weight_suggestion", f"SELECT * FROM {WEIGHTS}")
def _(t):
    return weights(t)


_BIG = "greatest(abs(quant_change), abs(qual_change))"


@query("weight_decision", f"""SELECT reason IS NULL AS applied, reason, quant_weight, qual_weight, confidence, n FROM (SELECT *, CASE WHEN status <> 'ok' THEN concat('status=', status) WHEN NOT oos_passed THEN 'oos_failed' WHEN confidence = 'low' THEN 'low_confidence'
  WHEN {_BIG} > 0.1e0 THEN 'change_too_large' WHEN {_BIG} < 0.03e0 THEN 'no_meaningful_change' END AS reason FROM {WEIGHTS})""")
def _(t):
    return R.weights_decision(weights(t))


_VSEL = f"WITH x AS (SELECT *, n_vetoes >= 10 AS ok, abs(missed_alpha) / greatest(max(CASE WHEN n_vetoes >= 10 THEN abs(missed_alpha) END) OVER (), 1e-300) AS cost FROM {QP.SWEEP}), y AS ({QP._SEL})"


@query("veto_threshold_decision", f"""{_VSEL} SELECT reason IS NULL AS applied, reason, recommended_threshold FROM (SELECT *, CASE WHEN status <> 'ok' THEN concat('status=', status) WHEN recommended_threshold IS NULL THEN 'no_recommendation' WHEN abs(recommended_threshold - 0.6e0) < 0.1e0 THEN 'too_close' END AS reason FROM y)""")
def _(t):
    sel = P.select_veto_threshold(P.veto_thresholds(QP.matched(t)))
    return R.threshold_decision(sel, 0.6)


_HIST = " UNION ALL ".join(f"SELECT '{s}' AS sub_score, score_date AS run_date, {r(f'avg({s}_score) / 100', 4)} AS weight FROM {{scored_signals}} WHERE date_diff('day', DATE '2001-06-29', score_date) % 7 = 0 GROUP BY score_date" for s in R.SUB_SCORES)


@query("weight_reversals", f"""WITH h AS ({_HIST}),
 j AS (SELECT c.sub_score, c.run_date, list(p.weight ORDER BY p.run_date) AS ws FROM h c JOIN h p ON p.sub_score = c.sub_score AND date_diff('day', p.run_date, c.run_date) IN (0, 7, 14, 21) GROUP BY 1, 2),
 e AS (SELECT *, list_filter(list_transform(range(1, len(ws)), lambda i: {r('ws[i + 1] - ws[i]', 8)}), lambda x: x IS NOT NULL) AS ds FROM j),
 n AS (SELECT *, CAST(len(list_filter(range(1, len(ds)), lambda i: ds[i] * ds[i + 1] < 0)) AS INT) AS n_reversals FROM e)
 SELECT sub_score, CAST(run_date AS VARCHAR) AS run_date, CAST(len(ws) - 1 AS INT) AS weeks_loaded, n_reversals, n_reversals = 0 AS stable FROM n""")
def _(t):
    """Stability of the weights at each weekly run, over the runs one, two and three weeks before it."""
    days = t.scored_signals.filter("datediff(score_date, DATE '2001-06-29') % 7 = 0")
    h = days.groupBy(F.col("score_date").alias("run_date")).agg(*[rnd(F.avg(f"{s}_score") / 100, 4).alias(s) for s in R.SUB_SCORES])
    return R.weight_stability(h.unpivot("run_date", list(R.SUB_SCORES), "sub_score", "weight"))


# --- parameter moves ----------------------------------------------------------------------

_BP = """(SELECT key, CASE key WHEN 'short_interest_buy_boost' THEN 1.5e0 + d % 3 WHEN 'institutional_boost' THEN CASE WHEN d % 4 <> 1 THEN 2e0 + d % 5 ELSE v END ELSE v END AS value FROM
 (VALUES ('short_interest_buy_boost', 2e0), ('short_interest_high_boost', 4e0), ('institutional_boost', 3e0), ('institutional_min_funds', 3e0)) p(key, v), (SELECT max(c_custkey) AS d FROM {customer}))"""


def boost_params(t):
    """The boosts of the last parameter document, defaults for those it lacks."""
    base = {"short_interest_buy_boost": 2.0, "short_interest_high_boost": 4.0, "institutional_boost": 3.0, "institutional_min_funds": 3.0}
    docs = t.boost_docs.agg(F.max_by(F.struct("doc_id", "body"), "doc_id").alias("d")).select("d.*")
    return DOC.parameters(docs, base).select("key", "value")


_DRV = "(VALUES ('short_interest_buy_boost', 'short_interest_adj'), ('short_interest_high_boost', 'short_interest_adj'), ('institutional_boost', 'institutional_boost')) d(key, boost)"
_MV = r("value * 0.7e0 + value * f * 0.3e0", 2)


@query("boost_recommendation", f"""SELECT key, value, nv AS new_value, {r('nv - value', 4)} AS change FROM (SELECT *, coalesce(CASE WHEN abs({_MV} - value) / abs(value) > 0.5e0 THEN {r('value * (1 + sign(f - 1) * 0.5e0)', 4)} ELSE {_MV} END, value) AS nv FROM (
  SELECT p.*, CASE WHEN n_nonzero >= 10 AND r_10d > 0.05e0 THEN 1.15e0 WHEN n_nonzero >= 10 AND r_10d < -0.05e0 THEN 0.85e0 END AS f FROM {_BP} p LEFT JOIN {_DRV} USING (key) LEFT JOIN ({BOOST_ROWS}) c USING (boost)))""")
def _(t):
    drivers = {"short_interest_buy_boost": "short_interest_adj", "short_interest_high_boost": "short_interest_adj",
               "institutional_boost": "institutional_boost"}
    return R.boost_moves(boost_params(t), boost_rows(t), drivers)


_RX = f"(SELECT gate FROM ({QP._GATE}) WHERE leakage_rate > 0.15e0 AND (SELECT {QP._LEAK} > 0.15e0 FROM {QP._SCAN}))"
_NV = f"""CASE key WHEN 'tech_score_min' THEN CASE WHEN 'tech_score' IN (SELECT gate FROM {_RX}) THEN greatest({r('value * 0.7e0 + value * 0.8e0 * 0.3e0', 0)}, 40e0) ELSE value END
  WHEN 'max_atr_pct' THEN CASE WHEN 'volatility_pass' IN (SELECT gate FROM {_RX}) THEN least({r('value * 0.7e0 + value * 1.2e0 * 0.3e0', 1)}, 15e0) ELSE value END
  ELSE CASE WHEN 'liquidity_pass' IN (SELECT gate FROM {_RX}) THEN greatest(floor(value * 0.7e0 + value * 0.8e0 * 0.3e0 + 1e-9), 100000e0) ELSE value END END"""
_SP = f"(SELECT * FROM {PARAMS} WHERE doc_id = (SELECT max(c_custkey) FROM {{customer}}))"


def scanner_params(t):
    last = t.parameter_docs.agg(F.max_by(F.struct("doc_id", "body"), "doc_id").alias("d")).select("d.*")
    return DOC.parameters(last, SCANNER_DEFAULTS).select("key", "value")


def relax(t):
    s, u = t.scanner_evaluations, t.universe_returns
    return P.gates_to_relax(P.gate_leakage(s, u), P.scanner_leakage(s, u))


_MOVES = f"(SELECT key, value, {_NV} AS new_value FROM {_SP})"


@query("scanner_recommendation", f"SELECT *, {r('new_value - value', 4)} AS change FROM {_MOVES}")
def _(t):
    return R.scanner_moves(scanner_params(t), relax(t))


@query("merged_parameters", f"SELECT key, new_value AS value, CASE WHEN new_value <> value THEN '2001-08-01' END AS updated_on, CASE WHEN new_value <> value THEN 'scanner leakage' END AS reason FROM {_MOVES}")
def _(t):
    """Existing parameters with the moved ones written over them."""
    p = scanner_params(t)
    moved = R.scanner_moves(p, relax(t)).filter("change <> 0").select("key", F.col("new_value").alias("value"))
    return R.merge_parameters(p, moved, "2001-08-01", "scanner leakage")


# --- triggers, teams, committee --------------------------------------------------------------

_TS = f"(SELECT {category_sql('trigger_type', ENTRY_TRIGGERS)} AS trigger, {_SCORE} FROM {_ENT} GROUP BY 1 HAVING count(*) >= 3)"


_LOSES, _FAILS = "coalesce(avg_realized_alpha < -0.005e0, false)", "coalesce(win_rate_vs_spy < 0.4e0, false)"


@query("trigger_recommendation", f"""SELECT trigger, n_trades, ev AS evaluated, CASE WHEN bad AND NOT spared THEN 'disable' ELSE 'keep' END AS action,
  CASE WHEN NOT ev THEN 'insufficient_data' WHEN spared THEN 'preserved_as_fallback' ELSE concat_ws('; ', CASE WHEN {_LOSES} THEN 'negative_alpha' END,
    CASE WHEN avg_slippage_vs_open * 100 > 20 THEN 'high_slippage' END, CASE WHEN {_FAILS} THEN 'low_win_rate' END) END AS reasons,
  CASE WHEN ev THEN {r('avg_realized_alpha', 4)} END AS avg_alpha, CASE WHEN ev THEN {r('win_rate_vs_spy', 3)} END AS win_rate
 FROM (SELECT *, bad AND trigger = 'time_expiry' AND count(CASE WHEN bad THEN 1 END) OVER () >= count(CASE WHEN ev THEN 1 END) OVER () AS spared
  FROM (SELECT *, n_trades >= 50 AS ev, n_trades >= 50 AND ({_LOSES} OR {_FAILS}) AS bad FROM {_TS}))""")
def _(t):
    return R.trigger_actions(TR.trigger_scorecard(t.trades)).withColumn("reasons", F.array_join("reasons", "; "))


_SLOT = "(SELECT concat('team_', CAST(s_suppkey % 6 AS VARCHAR)) AS team_id, CAST(1 + max(s_suppkey) % 5 AS BIGINT) AS slots FROM {supplier} WHERE s_suppkey % 6 <> 5 GROUP BY 1)"
_CHG = "CASE WHEN lift < -0.005e0 THEN -1 WHEN lift > 0.005e0 THEN 1 ELSE 0 END"


_ND = "(SELECT count(DISTINCT eval_date) FROM {universe_returns})"


def lift_dates(t):
    return t.universe_returns.agg(F.countDistinct("eval_date").alias("n_dates"))


@query("team_slot_recommendation", f"""SELECT team_id, lift, lift_vs_quant, n_picks, CASE WHEN lift IS NULL THEN 'no_data' WHEN lift < -0.005e0 THEN 'underperforming' WHEN lift > 0.005e0 THEN 'outperforming' ELSE 'neutral' END AS assessment, {_CHG} AS slot_change, slots,
  CASE WHEN slots IS NOT NULL THEN greatest(1, least(slots + {_CHG}, 5)) END AS recommended_slots, CASE WHEN {_ND} >= 8 THEN 'ok' ELSE 'insufficient_data' END AS status FROM ({TEAM}) LEFT JOIN {_SLOT} USING (team_id)""")
def _(t):
    slots = t.supplier.filter("s_suppkey % 6 <> 5").groupBy(F.concat(F.lit("team_"), (F.col("s_suppkey") % 6).cast("string")).alias("team_id")).agg(
        (1 + F.max("s_suppkey") % 5).alias("slots"))
    return R.team_slots(L.team_lift(t.universe_returns, t.team_candidates), slots, lift_dates(t))


@query("committee_recommendation", f"SELECT *, CASE WHEN coalesce(cio_vs_ranking_lift < 0, false) OR coalesce(cio_lift < -0.005e0, false) THEN 'deterministic' ELSE 'keep' END AS recommendation, CASE WHEN {_ND} >= 8 THEN 'ok' ELSE 'insufficient_data' END AS status FROM (SELECT (SELECT lift FROM ({CIO})) AS cio_lift, (SELECT lift FROM ({RANKING})) AS cio_vs_ranking_lift)")
def _(t):
    return R.committee_mode(L.committee_lift(t.universe_returns, t.cio_evaluations),
                            L.committee_vs_ranking(t.universe_returns, t.cio_evaluations), lift_dates(t))


# --- variants and comparisons -------------------------------------------------------------------

_VW = {"plain": (0.01, 0.001), "tilted": (0.02, -0.001), "rsi": (0.0, 0.002)}


@query("variant_scores", " UNION ALL ".join(
    f"SELECT '{n}' AS variant, count(*) AS n, {r('avg(x)')} AS mean_alpha, {r('stddev_samp(x)')} AS std_alpha, {r(pearson_sql('x', 'y', 2))} AS ic FROM (SELECT {a}e0 * f.breadth + {b}e0 * f.rsi_14 AS x, o.actual_5d_return AS y FROM {{features}} f LEFT JOIN {{event_outcomes}} o ON o.symbol = f.ticker AND o.prediction_date = f.date WHERE f.atr_14_pct IS NOT NULL AND f.momentum_20d IS NOT NULL)"
    for n, (a, b) in _VW.items()))
def _(t):
    """Several models over the same rows: the model is a column, the rows are read once."""
    rows = I.scoreable_rows(t.features, NAMES)
    o = t.event_outcomes.select(F.col("symbol").alias("ticker"), F.col("prediction_date").alias("date"), F.col("actual_5d_return").alias("y"))
    x = F.explode(F.array(*[F.struct(F.lit(n).alias("variant"), (a * F.col("breadth") + b * F.col("rsi_14")).alias("x")) for n, (a, b) in _VW.items()]))
    from assay.functions.aggregates import pearson
    long = rows.join(o, ["ticker", "date"], "left").select(x.alias("v"), "y").select("v.*", "y")
    return long.groupBy("variant").agg(F.count("*").alias("n"), rnd(F.avg("x"), 6).alias("mean_alpha"),
                                       rnd(F.stddev_samp("x"), 6).alias("std_alpha"), rnd(pearson("x", "y"), 6).alias("ic"))


#: NAV and statistics of the daily series dy(variant, date, ret).
SERIES = f"""vn AS (SELECT variant, date, 1000000e0 * exp(sum(ln(greatest(1 + ret, 1e-9))) OVER (PARTITION BY variant ORDER BY date ROWS UNBOUNDED PRECEDING)) AS nav FROM dy),
 vr AS (SELECT *, CASE WHEN prev IS NULL THEN NULL WHEN prev > 0 THEN nav / prev - 1 ELSE 0e0 END AS daily_return, CASE WHEN peak > 0 THEN (nav - peak) / peak ELSE 0e0 END AS drawdown FROM (
   SELECT *, max(nav) OVER (PARTITION BY variant ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak, lag(nav) OVER (PARTITION BY variant ORDER BY date) AS prev FROM vn)),
 vs AS (SELECT variant, n_dates, {r('tr')} AS total_return, {r('CASE WHEN k >= 2 AND s > 1e-15 THEN m / s * sqrt(252e0) ELSE 0e0 END')} AS sharpe_ratio, {r('mdd')} AS max_drawdown,
   {r('CASE WHEN n_dates >= 2 AND mdd < 0 THEN (CASE WHEN 1 + tr > 0 THEN pow(1 + tr, 252e0 / n_dates) - 1 ELSE -1e0 END) / abs(mdd) ELSE 0e0 END')} AS calmar_ratio
  FROM (SELECT variant, count(*) AS n_dates, max_by(nav, date) / 1000000e0 - 1 AS tr, avg(daily_return) AS m, stddev_samp(daily_return) AS s, count(daily_return) AS k, min(drawdown) AS mdd FROM vr GROUP BY 1))"""
TOP = 10


def _model_sql(models: dict[str, tuple[str, list[str]]]) -> str:
    """dy of several models (score, features that must be known): each day's TOP rows by score."""
    parts = " UNION ALL ".join(
        f"SELECT '{v}' AS variant, f.ticker, f.date, {score} AS score, o.actual_5d_return / 100 AS y FROM {{features}} f LEFT JOIN {{event_outcomes}} o ON o.symbol = f.ticker AND o.prediction_date = f.date WHERE {' AND '.join(f'f.{n} IS NOT NULL' for n in known)}"
        for v, (score, known) in models.items())
    return f"dy AS (SELECT variant, date, coalesce(avg(y), 0e0) AS ret, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY variant, date ORDER BY score DESC, ticker) AS place FROM ({parts})) WHERE place <= {TOP} GROUP BY 1, 2)"


def _with_outcomes(t):
    o = t.event_outcomes.select(F.col("symbol").alias("ticker"), F.col("prediction_date").alias("date"), (F.col("actual_5d_return") / 100).alias("y"))
    return t.features.join(o, ["ticker", "date"], "left")


_VS = f"{_model_sql({n: (f'{a}e0 * f.breadth + {b}e0 * f.rsi_14', NAMES) for n, (a, b) in _VW.items()})}, {SERIES}"


def variant_series(t):
    known = reduce(lambda a, b: a & b, [F.col(n).isNotNull() & ~F.isnan(n) for n in NAMES])
    return V.model_series(_with_outcomes(t), {n: F.when(known, a * F.col("breadth") + b * F.col("rsi_14")) for n, (a, b) in _VW.items()}, "y", TOP)


@query("variant_statistics", f"WITH {_VS} SELECT vs.*, n_signals FROM vs JOIN (SELECT variant, sum(n)::BIGINT AS n_signals FROM dy GROUP BY 1) USING (variant)")
def _(t):
    """Every model's own series of daily top signals, and its statistics."""
    d = variant_series(t)
    return V.series_statistics(d).join(d.groupBy("variant").agg(F.sum("n").alias("n_signals")), "variant")


@query("variant_choice", f"""WITH {_VS}, v AS (SELECT variant, sharpe_ratio FROM vs), ny AS (SELECT date_diff('day', min(date), max(date)) / 365.25e0 AS years FROM dy), b AS (SELECT max(CASE WHEN variant = 'plain' THEN sharpe_ratio END) AS bs FROM v), o AS (SELECT * FROM v WHERE variant <> 'plain' ORDER BY sharpe_ratio DESC, variant DESC LIMIT 1),
 z AS (SELECT *, sharpe_ratio > bs AS better, coalesce((sharpe_ratio - bs) / nullif(abs(bs), 0), 0e0) AS g FROM b, o, ny), s AS (SELECT *, CASE WHEN NOT better THEN 'baseline_best' WHEN g < 0.1e0 THEN 'below_threshold' WHEN years < 5 THEN 'insufficient_history' ELSE 'ok' END AS status FROM z)
 SELECT CASE WHEN better THEN variant ELSE 'plain' END AS best_variant, CASE WHEN better THEN sharpe_ratio ELSE bs END AS best_sharpe, bs AS baseline_sharpe, {r('CASE WHEN better THEN g END', 4)} AS improvement, status, CASE WHEN status = 'ok' THEN variant END AS recommended_variant FROM s""")
def _(t):
    d = variant_series(t)
    years = d.agg((F.datediff(F.max("date"), F.min("date")) / 365.25).alias("n_years"))
    return R.best_variant(with_scalars(V.series_statistics(d).select("variant", "sharpe_ratio"), years), "plain", "n_years")


CUTS = [0.0, 0.005, 0.01, 0.015, 0.02, 0.025, 0.03]
_CUT = f"(SELECT c AS cutoff, count(*) AS n_predictions, count(DISTINCT date) AS n_dates, {r('count(*) * 1e0 / count(DISTINCT date)', 4)} AS predictions_per_day FROM {{brand_bars}} b JOIN (VALUES {', '.join(f'({c}e0)' for c in CUTS)}) t(c) ON c <= 0 OR b.alpha >= c GROUP BY 1)"


@query("alpha_cutoffs", f"SELECT * FROM {_CUT}")
def _(t):
    return R.alpha_cutoffs(t.brand_bars.select("date", "alpha"), CUTS)


@query("alpha_filtered_predictions", "SELECT ticker, CAST(date AS VARCHAR) AS date, alpha FROM {brand_bars} WHERE alpha >= 0.02e0")
def _(t):
    return t.brand_bars.filter("alpha >= 0.02D").select("ticker", "date", "alpha")


_CP = {c: f"alpha >= {c}e0" if c > 0 else "true" for c in CUTS}
_CS = ("dy AS (SELECT d.variant, d.date, coalesce(ret, 0e0) AS ret, coalesce(n, 0) AS n FROM (SELECT DISTINCT date, v AS variant FROM {brand_signals}, (VALUES "
       + ", ".join(f"({c}e0)" for c in CUTS) + ") q(v)) d LEFT JOIN (SELECT variant, date, avg(fwd) AS ret, count(*) AS n FROM ("
       + " UNION ALL ".join(f"SELECT {c}e0 AS variant, date, fwd, row_number() OVER (PARTITION BY date ORDER BY score DESC, ticker) AS place FROM {{brand_signals}} WHERE {p}" for c, p in _CP.items())
       + f") WHERE place <= 5 GROUP BY 1, 2) x ON x.variant = d.variant AND x.date = d.date), {SERIES}")


def cutoff_stats(t):
    return V.series_statistics(V.cutoff_series(t.brand_signals, CUTS, 5), "cutoff")


@query("cutoff_statistics", f"WITH {_CS} SELECT variant AS cutoff, n_dates, total_return, sharpe_ratio, max_drawdown, calmar_ratio FROM vs")
def _(t):
    """The run of each cut-off: its five best signals of every day, all cut-offs in one pass."""
    return cutoff_stats(t)


@query("alpha_cutoff_choice", f"""WITH {_CS}, c AS (SELECT u.*, vs.sharpe_ratio FROM {_CUT} u JOIN vs ON vs.variant = u.cutoff), b AS (SELECT max(CASE WHEN cutoff = 0 THEN sharpe_ratio END) AS bs FROM c), z AS (SELECT *, coalesce((sharpe_ratio - bs) / nullif(abs(bs), 0), 0e0) AS g FROM c, b ORDER BY sharpe_ratio DESC, cutoff LIMIT 1)
 SELECT cutoff AS best_cutoff, sharpe_ratio AS best_sharpe, predictions_per_day, {r('g', 4)} AS improvement, CASE WHEN sharpe_ratio > bs AND g >= 0.05e0 THEN cutoff END AS recommended_cutoff FROM z""")
def _(t):
    """Each cut-off with the Sharpe ratio of its own run."""
    rows = R.alpha_cutoffs(t.brand_bars.select("date", "alpha"), CUTS).join(cutoff_stats(t).select("cutoff", "sharpe_ratio"), "cutoff")
    base = rows.agg(F.max(F.when(F.col("cutoff") == 0, F.col("sharpe_ratio"))).alias("bs"))
    return R.choose_cutoff(with_scalars(rows, base), F.col("bs"))


_M6 = ["sharpe_ratio", "total_alpha", "max_drawdown", "win_rate", "total_return", "total_trades"]


@query("twin_comparison", f"WITH {_RK} SELECT metric, before, after, {r('after - before')} AS delta FROM (" + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, CAST(max(CASE WHEN nearness = 1 THEN {m} END) AS DOUBLE) AS before, CAST(max(CASE WHEN \"rank\" = 1 THEN {m} END) AS DOUBLE) AS after FROM rk" for m in _M6) + ")")
def _(t):
    """The run of the combination in use (the nearest one) against that of the best combination."""
    runs = ranked(t).select(*_M6, F.inline(F.array_compact(F.array(*[
        F.when(F.col(c) == 1, F.struct(F.lit(n).alias("run"))) for c, n in (("nearness", "before"), ("rank", "after"))]))))
    return R.compare_pair(runs, "run", "before", "after", _M6)


_NOISE = ["breadth"]
_AB = {"full": (" + ".join(f"{w}e0 * f.{n}" for n, w in MODEL.items()), NAMES),
       "pruned": (" + ".join(f"{w}e0 * f.{n}" for n, w in MODEL.items() if n not in _NOISE), [n for n in NAMES if n not in _NOISE])}
_G2 = "coalesce((b - a) / nullif(abs(a), 0), 0e0)"


@query("feature_ablation", f"""WITH {_model_sql(_AB)}, {SERIES}, pd AS (SELECT date, max(CASE WHEN variant = 'pruned' THEN ret END) - max(CASE WHEN variant = 'full' THEN ret END) AS d FROM dy GROUP BY 1)
 SELECT a AS baseline_sharpe, b AS pruned_sharpe, {r(f'{_G2} * 100', 2)} AS sharpe_change_pct, {_G2} >= -0.05e0 AS recommend_pruning, n_paired, {r('m', 8)} AS mean_diff, {r('CASE WHEN s > 1e-15 THEN m / s * sqrt(n_paired) END', 4)} AS t_stat
 FROM (SELECT max(CASE WHEN variant = 'full' THEN sharpe_ratio END) AS a, max(CASE WHEN variant = 'pruned' THEN sharpe_ratio END) AS b FROM vs), (SELECT count(d) AS n_paired, avg(d) AS m, stddev_samp(d) AS s FROM pd)""")
def _(t):
    """The model with all features against the one without its noise candidates, both scored on every row of one scan."""
    def model(zero):
        rest = [n for n in NAMES if n not in zero]
        known = reduce(lambda a, b: a & b, [F.col(n).isNotNull() & ~F.isnan(n) for n in rest])
        return F.when(known, reduce(lambda a, b: a + b, [F.lit(float(w)) * F.col(n) for n, w in MODEL.items() if n in rest]))

    daily = V.model_series(_with_outcomes(t), {"full": model([]), "pruned": model(_NOISE)}, "y", TOP)
    return with_scalars(R.ablation(V.series_statistics(daily), "variant", "full", "pruned"), V.paired_statistics(daily, "full", "pruned"))


_SD = "CASE WHEN sa <> 0 AND sb <> 0 THEN sa - sb END"
_SZW = f"""dw AS (SELECT date, count(*) AS n, sum(position_pct * ret) AS own_ret, sum(position_pct * alpha) AS own_alpha, avg(position_pct) * sum(ret) AS even_ret, avg(position_pct) * sum(alpha) AS even_alpha, greatest(sum(position_pct), 1e0) AS scale
   FROM (SELECT date, position_pct, realized_return_pct / 100 AS ret, realized_alpha_pct / 100 AS alpha FROM {{trades}} WHERE action = 'ENTER' AND realized_return_pct IS NOT NULL AND realized_alpha_pct IS NOT NULL) GROUP BY 1),
 dy AS (SELECT 'sized' AS variant, date, own_ret / scale AS ret, own_alpha / scale AS alpha, n FROM dw UNION ALL SELECT 'equal', date, even_ret / scale, even_alpha / scale, n FROM dw), {SERIES},
 sz AS (SELECT vs.*, total_trades, total_alpha FROM vs JOIN (SELECT variant, sum(n)::BIGINT AS total_trades, {r('sum(alpha)')} AS total_alpha FROM dy GROUP BY 1) USING (variant))"""


def sizing_stats(t):
    """Statistics of the entries at their own sizes and at equal ones."""
    entries = t.trades.filter("action = 'ENTER' AND realized_return_pct IS NOT NULL AND realized_alpha_pct IS NOT NULL")
    daily = V.weighting_series(entries.select("date", (F.col("realized_return_pct") / 100).alias("ret"),
                                              (F.col("realized_alpha_pct") / 100).alias("alpha"), F.col("position_pct").alias("weight")))
    sums = daily.groupBy("variant").agg(F.sum("n").alias("total_trades"), rnd(F.sum("alpha"), 6).alias("total_alpha"))
    return V.series_statistics(daily).join(sums, "variant")


@query("weighting_statistics", f"WITH {_SZW} SELECT * FROM sz")
def _(t):
    return sizing_stats(t)


#: Both runs over all held days, with the statistics of a portfolio.
_RUNS = STATS.replace("{order_log}", "{sizing_log}").replace("{combos} c", "(VALUES ('sized'), ('equal')) c(combo_id)")


def sizing_runs(t):
    """Portfolio statistics of two runs over all trades and held days: at their own sizes, and at the mean size of the entries."""
    cal = t.kept("calendar", lambda: calendar(t.market_state))
    mean = t.trades.filter("action = 'ENTER'").agg(rnd(F.avg("position_pct"), 6).alias("__mean"))
    trades = with_scalars(t.trades, mean).withColumn("research_score", F.lit(0.0))  # no threshold: every trade is in both
    runs = t.spark.createDataFrame([("sized",), ("equal",)], "combo_id string")

    def days(run, pct):
        book = t.spark.createDataFrame([(run, 0.0, 1.0)], "combo_id string, min_score double, max_position_pct double")
        sized = trades.withColumn("shares", F.col("shares") * F.col(pct))
        return PF.book_days(PF.order_books(sized, t.market_state, book))

    both = t.kept("sizing_days", lambda: days("sized", "position_pct").unionByName(days("equal", "__mean")))
    spy = PF.benchmark_return(t.market_state.filter("ticker = 'S0'").select("date", "close"), cal.select("date"))
    return PF.combo_statistics(runs, PF.nav_of_days(both, cal, CASH), None, spy, CASH, counts=PF.counts_of_days(both))


@query("sizing_comparison", f"WITH {_RUNS} SELECT CASE WHEN least(ta, tb) < 50 THEN 'insufficient_data' ELSE 'ok' END AS status, {r(_SD, 3)} AS sharpe_diff, {r('ra - rb', 4)} AS return_diff, {r('aa - ab', 4)} AS alpha_diff, CASE WHEN {_SD} > 0.1e0 THEN 'sizing_helps' WHEN {_SD} < -0.1e0 THEN 'equal_weight_better' ELSE 'no_difference' END AS assessment FROM (SELECT "
       + ", ".join(f"max(CASE WHEN combo_id = '{k}' THEN {c} END) AS {x}{n}" for n, k in (("a", "sized"), ("b", "equal")) for x, c in (("t", "total_trades"), ("s", "sharpe_ratio"), ("r", "total_return"), ("a", "total_alpha"))) + " FROM cs)")
def _(t):
    return R.sizing_comparison(sizing_runs(t), "combo_id", "sized", "equal")


# --- regression, alerts, decisions ------------------------------------------------------------------

_REG = f"""dy AS (SELECT CASE WHEN score_date < DATE '2000-01-01' THEN 'base' ELSE 'now' END AS variant, score_date AS date, coalesce(avg(return_10d), 0e0) / 100 AS ret FROM {{scored_signals}} WHERE return_10d IS NOT NULL GROUP BY 1, 2), {SERIES},
 ac AS (SELECT avg(CASE WHEN score_date < DATE '2000-01-01' THEN beat_spy_10d END) AS ba, avg(CASE WHEN score_date >= DATE '2000-01-01' THEN beat_spy_10d END) AS ca FROM {{scored_signals}}),
 sr AS (SELECT max(CASE WHEN variant = 'base' THEN sharpe_ratio END) AS bs, max(CASE WHEN variant = 'now' THEN sharpe_ratio END) AS csh FROM vs)"""


@query("regression_check", f"WITH {_REG} SELECT true AS checked, {r('(ba - ca) * 100', 4)} AS accuracy_drop, {r('CASE WHEN bs > 0 THEN (bs - csh) / abs(bs) END', 4)} AS sharpe_drop_pct, coalesce((ba - ca) * 100 > 5, false) OR coalesce(bs > 0 AND (bs - csh) / abs(bs) > 0.2e0, false) AS regression_detected FROM ac, sr")
def _(t):
    """Accuracy and Sharpe ratio of the signals' daily mean return, before and since the turn of the year."""
    period = F.when(F.col("score_date") < F.lit("2000-01-01").cast("date"), "base").otherwise("now")
    s = t.scored_signals.select(period.alias("variant"), F.col("score_date").alias("date"), "return_10d", "beat_spy_10d")
    daily = s.filter("return_10d IS NOT NULL").groupBy("variant", "date").agg((F.avg("return_10d") / 100).alias("ret"))
    hits = s.groupBy("variant").agg(F.avg("beat_spy_10d").alias("accuracy_10d"))
    row = V.series_statistics(daily).join(hits, "variant").select("variant", "accuracy_10d", "sharpe_ratio")
    return R.regression_check(row.filter("variant = 'now'"), row.filter("variant = 'base'"))


def triggers(t):
    o = t.predictor_outcomes
    health = P.production_health(o, QP.ASOF, training_ic=2.0, lookback_days=120)
    cal = P.calibration_summary(P.calibration_bins(o, QP.ASOF, min_bin=15))
    return R.retrain_triggers(health, P.drift_summary(QP._drift(t)), cal, P.regime_ic(o, t.macro_snapshots, QP.ASOF, 400),
                              QP.ASOF, "2001-01-01")


_IC = r(pearson_sql("net", "actual_5d_return", 10), 4)
_TRIG = f"""(SELECT 'ic_degradation' AS trigger, 'high' AS severity, {r('ic / 2e0', 2)} AS value FROM (SELECT {_IC} AS ic FROM {QP.recent_sql(120)}) WHERE {r('ic / 2e0', 2)} < 0.5e0
 UNION ALL SELECT 'feature_drift', 'high', {r(QP._FR, 3)} FROM (SELECT count(CASE WHEN status <> 'stable' THEN 1 END) AS n_drifted, count(*) AS total_features FROM d) WHERE {r(QP._FR, 3)} > 0.2e0
 UNION ALL SELECT 'calibration_breakdown', 'medium', e FROM (SELECT {QP._ECE} AS e FROM {QP.BINS}) WHERE e > 0.1e0
 UNION ALL SELECT * FROM (SELECT 'regime_negative_ic', 'medium', ic FROM (SELECT market_regime AS regime, {_IC} AS ic FROM {QP.recent_sql(400)} o JOIN {{macro_snapshots}} m ON o.prediction_date = m.date GROUP BY 1) WHERE ic < 0 ORDER BY CASE regime WHEN 'bull' THEN 0 WHEN 'neutral' THEN 1 WHEN 'bear' THEN 2 ELSE 3 END LIMIT 1)
 UNION ALL SELECT 'mode_collapse', 'high', s FROM (SELECT max(c) AS s FROM (SELECT {r('count(*) * 1e0 / sum(count(*)) OVER ()', 3)} AS c FROM {QP.recent_sql(120)} GROUP BY predicted_direction)) WHERE s > 0.75e0)"""


@query("retrain_triggers", f"WITH {QP._DRIFT} SELECT * FROM {_TRIG}")
def _(t):
    return triggers(t)


@query("alert_decision", f"""WITH {QP._DRIFT} SELECT *, n_triggers > 0 AS triggered, CASE WHEN n_triggers = 0 THEN 'no_triggers' WHEN DATE '{QP.ASOF}' - last_alert_d < 2 THEN 'suppressed' ELSE 'send' END AS decision FROM (
 SELECT count(*) AS n_triggers, count(CASE WHEN severity = 'high' THEN 1 END) AS n_high, (SELECT max(CAST(o_orderdate AS DATE)) FROM {{orders}} WHERE o_orderdate < DATE '2001-07-28') AS last_alert_d FROM {_TRIG})""".replace("SELECT *, n_triggers", "SELECT n_triggers, n_high, CAST(last_alert_d AS VARCHAR) AS last_alert, n_triggers"))
def _(t):
    past = t.orders.filter("o_orderdate < DATE '2001-07-28'").select(F.col("o_orderdate").cast("date").alias("date"))
    return R.alert_status(triggers(t), past, QP.ASOF)


_RES = "(SELECT o_custkey AS optimizer, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'ok' WHEN 2 THEN 'error' WHEN 3 THEN 'skipped' WHEN 4 THEN 'insufficient_data' ELSE 'ok' END AS status, o_orderkey % 14 = 5 AS applied, CASE WHEN o_orderkey % 14 = 6 THEN 'config frozen' WHEN o_orderkey % 14 = 13 THEN 'too close' END AS reason FROM {orders})"


def results(t):
    k = F.col("o_orderkey")
    m = k % 7
    return t.orders.select(
        F.col("o_custkey").alias("optimizer"), F.when(m == 1, "ok").when(m == 2, "error").when(m == 3, "skipped").when(
            m == 4, "insufficient_data").when(m != 0, "ok").alias("status"), (k % 14 == 5).alias("applied"),
        F.when(k % 14 == 6, "config frozen").when(k % 14 == 13, "too close").alias("reason"))


@query("decision_labels", f"SELECT decision, count(*) AS n FROM (SELECT CASE WHEN status IS NULL THEN 'NOT RUN' WHEN applied THEN 'PROMOTED' WHEN contains(reason, 'frozen') THEN 'FROZEN' WHEN reason IS NOT NULL THEN 'REJECTED' WHEN status = 'ok' THEN 'EVALUATED' WHEN status = 'error' THEN 'ERROR' WHEN status = 'skipped' THEN 'SKIPPED' ELSE 'DEFERRED' END AS decision FROM {_RES}) GROUP BY 1")
def _(t):
    return R.decision_label(results(t)).groupBy("decision").agg(F.count("*").alias("n"))


@query("promoted_optimizers", f"SELECT optimizer, count(*) AS n FROM {_RES} WHERE applied GROUP BY 1")
def _(t):
    return R.promoted(results(t)).groupBy("optimizer").agg(F.count("*").alias("n"))


