"""Scorecard queries with their SQL oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators import grading as G
from assay.operators import lift as L
from assay.operators import predictor as P
from assay.operators import quality as Q
from assay.operators import recommend as R
from assay.operators import trades as TR
from assay.plans import queries_lift as QL
from assay.plans.queries_quality import SLICE
from assay.plans import queries_predictor, queries_recommend, queries_trades  # noqa: F401  (oracles used below)
from assay.plans.registry import ORACLES, query
from assay.plans.views import r


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def research_metrics(t) -> DataFrame:
    u, s = t.universe_returns, t.scored_signals
    rows = t.kept("research_rows", lambda: L.research_rows(u, t.scanner_evaluations, t.team_candidates, t.cio_evaluations))
    scanned = rows.filter("stage = 'scanner'")
    advised = L.resolved_universe(rows.filter("stage = 'committee'"))
    leak = P.leakage_of(scanned, scanned)
    overall = Q.overall_accuracy(s).filter("status = 'ok'")
    top = Q.accuracy_by_bucket(s).filter("bucket = '90+'")
    mono = Q.score_calibration(s, t.macro_snapshots).agg(F.max("monotonic").alias("m"))
    # three stages in one pass; a component gets its metrics by its own stage, and teams a set each
    stages = L.stage_metrics(L.research_stage_rows(u, rows))
    stages = stages.filter("stage = 'scanner' or (stage in ('teams', 'committee') and n_selected >= 3)").withColumns({
        "component": F.when(F.col("stage") == "teams", "team").otherwise(F.col("stage")),
        "item": F.when(F.col("stage") == "teams", F.col("team_id")).otherwise("")})
    own = lambda stage, column: F.when(F.col("stage") == stage, F.col(column))
    m = G.metric_rows
    return _union([
        m(stages, F.col("component"), {"precision": "precision", "recall": "recall", "lift": "lift",
                                       "lift_vs_quant": own("teams", "lift_vs_all"),
                                       "rejection_spread": own("committee", "spread")}, "item"),
        m(leak, "scanner", {"leakage": "leakage_rate"}),
        m(P.macro_of(advised), "macro", {"accuracy_lift": "accuracy_lift", "alpha_lift": "alpha_lift"}),
        m(L.ranking_of(advised), "committee", {"ranking_lift": "lift"}),
        m(overall, "composite", {"accuracy_10d": "accuracy_10d"}), m(top, "composite", {"top_accuracy": "accuracy_10d"}),
        m(mono, "composite", {"monotonic": F.when(F.col("m"), 90.0).when(~F.col("m"), 40.0)}),
    ])


def predictor_metrics(t) -> DataFrame:
    m = G.metric_rows
    sel = P.select_veto_threshold(P.veto_thresholds(queries_predictor.matched(t)))
    sel = sel.filter(F.col("status").isin("ok", "insufficient_lift"))
    sizing = P.predictor_sizing(t.predictor_outcomes)
    return _union([
        m(sizing, "meta_model", {"rank_ic": "overall_rank_ic", "sizing_lift": "sizing_lift",
                                 "stability": F.try_divide(F.col("recent_positive_weeks").cast("double"), "recent_total_weeks")}),
        m(sel, "veto_gate", {"precision": "precision", "recall": "recall", "lift": "lift"}),
        m(TR.veto_value(t.predictor_outcomes, t.shadow_book), "veto_gate", {"net_value": "net_veto_value"}),
    ])


def executor_metrics(t) -> DataFrame:
    m = G.metric_rows
    card = TR.trigger_scorecard(t.trades)
    names = {"slippage": "avg_slippage_vs_signal", "win_rate": "win_rate_vs_spy"}
    guard = TR.blocked_vs_traded(t.shadow_book, t.trades, t.universe_returns)
    exits = TR.exit_timing_summary(queries_trades.timed(t))
    overall = Q.overall_accuracy(t.scored_signals)
    return _union([
        m(card.filter("trigger = '(all)'"), "entry_triggers", {**names, "alpha": "avg_realized_alpha"}),
        m(card.filter("trigger <> '(all)'"), "trigger", names, "trigger"),
        m(guard, "risk_guard", {
            "precision": "precision", "recall": "recall", "lift": "guard_lift", "assessment": G.words("assessment", G.ASSESSMENT),
            "blocked_beat": F.when(F.col("precision").isNull(), F.col("blocked_beat_spy_pct"))}),
        m(exits, "exit_rules", {"capture": "avg_capture_ratio", "avg_return": "avg_realized_return",
                                "diagnosis": G.words("diagnosis", G.DIAGNOSIS)}),
        m(R.sizing_comparison(queries_recommend.sizing_runs(t), "combo_id", "sized", "equal").filter("status = 'ok'"), "position_sizing",
          {"sharpe_diff": "sharpe_diff", "alpha_diff": "alpha_diff"}),
        m(overall, "portfolio", {"accuracy_10d": "accuracy_10d", "avg_alpha": "avg_alpha_10d"}),
        m(queries_recommend.ranked(t).filter("nearness = 1"), "portfolio", {"sharpe": "sharpe_ratio", "max_drawdown": "max_drawdown"}),
    ])


def _rows(sql: str, component: str, metrics: dict[str, str], item: str = "''") -> str:
    return " UNION ALL ".join(
        f"SELECT '{component}' AS component, {item} AS item, '{m}' AS metric, CAST({c} AS DOUBLE) AS value FROM ({sql})" for m, c in metrics.items())


def _bare(name: str) -> str:
    """An oracle as a sub-select; its own WITH prefix moves inside."""
    return ORACLES[name]


PRL = {"precision": "precision", "recall": "recall", "lift": "lift"}
OVERALL = f"SELECT {SLICE} FROM {{scored_signals}}"
RESEARCH_SQL = " UNION ALL ".join([
    _rows(QL.SCANNER, "scanner", PRL), _rows(_bare("scanner_leakage"), "scanner", {"leakage": "leakage_rate"}),
    _rows(f"SELECT * FROM ({QL.TEAM}) WHERE n_picks >= 3", "team", {**PRL, "lift_vs_quant": "lift_vs_quant"}, "team_id"),
    _rows(_bare("macro_evaluation"), "macro", {"accuracy_lift": "accuracy_lift", "alpha_lift": "alpha_lift"}),
    _rows(f"SELECT * FROM ({QL.CIO}) WHERE n_advance >= 3", "committee", {**PRL, "rejection_spread": "advance_avg - reject_avg"}),
    _rows(QL.RANKING, "committee", {"ranking_lift": "lift"}), _rows(OVERALL, "composite", {"accuracy_10d": "accuracy_10d"}),
    _rows(f"SELECT * FROM ({_bare('signal_quality_by_bucket')}) WHERE bucket = '90+'", "composite", {"top_accuracy": "accuracy_10d"}),
    _rows(f"SELECT CASE WHEN bool_or(monotonic) THEN 90e0 ELSE 40e0 END AS m FROM ({_bare('score_calibration')})", "composite", {"monotonic": "m"}),
])
PREDICTOR_SQL = " UNION ALL ".join([
    _rows(_bare("predictor_sizing"), "meta_model", {"rank_ic": "overall_rank_ic", "sizing_lift": "sizing_lift", "stability": "recent_positive_weeks * 1e0 / nullif(recent_total_weeks, 0)"}),
    _rows(f"SELECT * FROM ({_bare('veto_threshold_selection')}) WHERE status IN ('ok', 'insufficient_lift')", "veto_gate", PRL),
    _rows(_bare("veto_value"), "veto_gate", {"net_value": "net_veto_value"}),
])
_TN = {"slippage": "avg_slippage_vs_signal", "win_rate": "win_rate_vs_spy"}
_CASE = lambda c, marks: "CASE " + c + " " + " ".join(f"WHEN '{k}' THEN {v}e0" for k, v in marks.items()) + " END"
EXECUTOR_SQL = " UNION ALL ".join([
    _rows(f"SELECT * FROM ({_bare('trigger_scorecard')}) WHERE trigger = '(all)'", "entry_triggers", {**_TN, "alpha": "avg_realized_alpha"}),
    _rows(f"SELECT * FROM ({_bare('trigger_scorecard')}) WHERE trigger <> '(all)'", "trigger", _TN, "trigger"),
    _rows(_bare("blocked_vs_traded"), "risk_guard", {"precision": "precision", "recall": "recall", "lift": "guard_lift", "assessment": _CASE("assessment", G.ASSESSMENT), "blocked_beat": "CASE WHEN precision IS NULL THEN blocked_beat_spy_pct END"}),
    _rows(_bare("exit_timing_summary"), "exit_rules", {"capture": "avg_capture_ratio", "avg_return": "avg_realized_return", "diagnosis": _CASE("diagnosis", G.DIAGNOSIS)}),
    _rows(f"SELECT * FROM ({_bare('sizing_comparison')}) WHERE status = 'ok'", "position_sizing", {"sharpe_diff": "sharpe_diff", "alpha_diff": "alpha_diff"}),
    _rows(OVERALL, "portfolio", {"accuracy_10d": "accuracy_10d", "avg_alpha": "avg_alpha_10d"}),
    _rows(f"WITH {queries_recommend._RK} SELECT * FROM rk WHERE nearness = 1", "portfolio", {"sharpe": "sharpe_ratio", "max_drawdown": "max_drawdown"}),
])

_RULES = "(VALUES " + ", ".join(f"('{c}', {n}, '{m}', '{k}', {a}e0, {b}e0, {w}e0)" for c, n, m, k, a, b, w in G.RULES) + ") ru(component, rule_set, metric, kind, a, b, weight)"
_NEED = "(VALUES " + ", ".join(f"('{c}', '{m}', {len(ms)})" for c, ms in G.NEEDED.items() for m in ms) + ") nd(component, metric, n_needed)"
_CL = lambda x: f"greatest(0e0, least(100e0, {x}))"
_GRADE = (f"CASE kind WHEN 'pct' THEN CASE WHEN a = b THEN 50e0 ELSE {_CL('30 + (value - a) / nullif(b - a, 0) * 65')} END "
          f"WHEN 'lift' THEN {_CL('CASE WHEN value <= 0 THEN CASE WHEN a = 0 THEN 40e0 ELSE 40 * (1 - value / nullif(a, 0)) END ELSE CASE WHEN b = 0 THEN 40e0 ELSE 40 + 60 * (value / nullif(b, 0)) END END')} "
          f"WHEN 'line' THEN {_CL('a + value * b')} WHEN 'ratio' THEN CASE WHEN value <= 0 THEN 0e0 WHEN value >= 1 THEN 100e0 WHEN value <= a THEN 80 * (value / a) ELSE 80 + 20 * ((value - a) / nullif(1 - a, 0)) END ELSE value END")
_LETTER = "CASE WHEN grade IS NULL THEN 'N/A' " + " ".join(f"WHEN grade >= {f} THEN '{n}'" for f, n in (
    (90, "A"), (80, "A-"), (73, "B+"), (65, "B"), (58, "B-"), (50, "C+"), (42, "C"), (35, "C-"), (28, "D+"), (20, "D"))) + " ELSE 'F' END"


def grades_sql(metrics: str, tag: str = "g") -> str:
    picky = ", ".join(f"'{c}'" for c in G.NEEDED)
    return f"""{tag}m AS ({metrics}), {tag}h AS (SELECT component, item, count(*) = max(n_needed) AS complete FROM {tag}m JOIN {_NEED} USING (component, metric) WHERE value IS NOT NULL GROUP BY 1, 2),
 {tag}r AS (SELECT component, item, {r('sum(weight * gr) / nullif(sum(CASE WHEN gr IS NOT NULL THEN weight END), 0)')} AS grade FROM (SELECT m.component, m.item, ru.weight, {_GRADE} AS gr FROM {tag}m m JOIN {_RULES} ON ru.component = m.component AND ru.metric = m.metric
   LEFT JOIN {tag}h h ON h.component = m.component AND h.item = m.item WHERE value IS NOT NULL AND rule_set = CASE WHEN m.component IN ({picky}) AND NOT coalesce(complete, false) THEN 2 ELSE 1 END) GROUP BY 1, 2),
 {tag} AS (SELECT component, item, grade, {_LETTER} AS letter FROM (SELECT DISTINCT component, item FROM {tag}m) LEFT JOIN {tag}r USING (component, item))"""


@query("research_grades", f"WITH {grades_sql(RESEARCH_SQL)} SELECT * FROM g")
def _(t):
    return G.component_grades(research_metrics(t))


@query("predictor_grades", f"WITH {grades_sql(PREDICTOR_SQL)} SELECT * FROM g")
def _(t):
    return G.component_grades(predictor_metrics(t))


@query("executor_grades", f"WITH {grades_sql(EXECUTOR_SQL)} SELECT * FROM g")
def _(t):
    return G.component_grades(executor_metrics(t))


_MW = "(VALUES " + ", ".join(f"('{m}', '{c}', {w}e0)" for m, cs in G.MODULES.items() for c, w in cs.items()) + ") mw(module, component, weight)"
_OW = "(VALUES " + ", ".join(f"('{m}', {w}e0)" for m, w in G.OVERALL.items()) + ") ow(module, weight)"


def _wavg(g: str, w: str) -> str:
    return r(f"sum({w} * {g}) / nullif(sum(CASE WHEN {g} IS NOT NULL THEN {w} END), 0)")


@query("scorecard", f"""WITH {grades_sql(RESEARCH_SQL, 'gr')}, {grades_sql(PREDICTOR_SQL, 'gp')}, {grades_sql(EXECUTOR_SQL, 'ge')},
 c1 AS (SELECT component, avg(grade) AS grade FROM (SELECT * FROM gr UNION ALL SELECT * FROM gp UNION ALL SELECT * FROM ge) GROUP BY 1),
 md AS (SELECT module, {_wavg('c1.grade', 'mw.weight')} AS grade FROM {_MW} LEFT JOIN c1 ON c1.component = mw.component GROUP BY 1),
 ov AS (SELECT {_wavg('md.grade', 'ow.weight')} AS grade, count(md.grade) AS n FROM {_OW} LEFT JOIN md ON md.module = ow.module)
 SELECT *, {_LETTER} AS letter FROM (SELECT 'module' AS level, module AS name, grade, NULL AS status FROM md UNION ALL SELECT 'overall', 'overall', grade, CASE WHEN n = 0 THEN 'insufficient_data' WHEN n < 3 THEN 'partial' ELSE 'ok' END FROM ov)""")
def _(t):
    """Every component, rolled up to modules and to one overall grade."""
    metrics = _union([m(t) for m in (research_metrics, predictor_metrics, executor_metrics)])
    return G.scorecard(G.component_means(G.component_grades(metrics)))


@query("letter_grades", f"SELECT o_orderkey, grade, {_LETTER} AS letter FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE {r('o_totalprice % 10000 / 100e0', 4)} END AS grade FROM {{orders}})")
def _(t):
    from assay.functions.scalars import letter, rnd
    g = F.when(F.col("o_orderkey") % 10 != 0, rnd(F.col("o_totalprice") % 10000 / 100.0, 4))
    return t.orders.select("o_orderkey", g.alias("grade")).withColumn("letter", letter("grade"))


