"""Component scorecard: metric rows times a rule table, rolled up twice.

``metrics``: (component, item, metric, value), one row per known number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions.aggregates import weighted_average
from assay.functions.scalars import clamp, letter, lift_grade, pct_grade, ratio_grade, rnd

# Fixed values: (component, rule set, metric, kind, a, b, weight).  The second rule set
# of a component is used when the first one lacks a number it needs.
RULES = [
    ("scanner", 1, "precision", "pct", 0.40, 0.65, 0.35), ("scanner", 1, "recall", "pct", 0.10, 0.40, 0.25),
    ("scanner", 1, "lift", "lift", -1.5, 2.5, 0.20), ("scanner", 1, "leakage", "line", 95.0, -283.0, 0.20),
    ("scanner", 2, "lift", "lift", -1.5, 2.5, 0.55), ("scanner", 2, "leakage", "line", 95.0, -283.0, 0.45),
    ("team", 1, "precision", "pct", 0.40, 0.70, 0.30), ("team", 1, "recall", "pct", 0.10, 0.50, 0.20),
    ("team", 1, "lift", "lift", -2.0, 3.0, 0.25), ("team", 1, "lift_vs_quant", "lift", -2.0, 3.0, 0.25),
    ("team", 2, "lift", "lift", -2.0, 3.0, 0.55), ("team", 2, "lift_vs_quant", "lift", -2.0, 3.0, 0.45),
    ("macro", 1, "accuracy_lift", "lift", -5.0, 5.0, 0.50), ("macro", 1, "alpha_lift", "lift", -1.0, 2.0, 0.50),
    ("committee", 1, "precision", "pct", 0.40, 0.75, 0.30), ("committee", 1, "recall", "pct", 0.30, 0.70, 0.20),
    ("committee", 1, "lift", "lift", -3.0, 3.0, 0.25), ("committee", 1, "ranking_lift", "lift", -2.0, 2.0, 0.25),
    ("committee", 2, "lift", "lift", -3.0, 3.0, 0.40), ("committee", 2, "rejection_spread", "lift", -2.0, 4.0, 0.30),
    ("committee", 2, "ranking_lift", "lift", -2.0, 2.0, 0.30),
    ("composite", 1, "accuracy_10d", "pct", 0.45, 0.70, 0.40), ("composite", 1, "top_accuracy", "pct", 0.50, 0.80, 0.30),
    ("composite", 1, "monotonic", "score", 0.0, 0.0, 0.30),
    ("meta_model", 1, "rank_ic", "line", 20.0, 700.0, 0.45), ("meta_model", 1, "stability", "pct", 0.40, 0.85, 0.30),
    ("meta_model", 1, "sizing_lift", "lift", -1.0, 2.0, 0.25),
    ("veto_gate", 1, "precision", "pct", 0.45, 0.80, 0.30), ("veto_gate", 1, "recall", "pct", 0.10, 0.50, 0.20),
    ("veto_gate", 1, "lift", "lift", -5.0, 20.0, 0.20), ("veto_gate", 1, "net_value", "line", 50.0, 0.05, 0.30),
    ("veto_gate", 2, "precision", "pct", 0.45, 0.80, 0.40), ("veto_gate", 2, "lift", "lift", -5.0, 20.0, 0.30),
    ("veto_gate", 2, "net_value", "line", 50.0, 0.05, 0.30),
    ("entry_triggers", 1, "slippage", "line", 55.0, -35.0, 0.35), ("entry_triggers", 1, "win_rate", "pct", 0.40, 0.65, 0.35),
    ("entry_triggers", 1, "alpha", "lift", -3.0, 5.0, 0.30),
    ("trigger", 1, "slippage", "line", 55.0, -35.0, 0.50), ("trigger", 1, "win_rate", "pct", 0.40, 0.65, 0.50),
    ("risk_guard", 1, "precision", "pct", 0.40, 0.75, 0.30), ("risk_guard", 1, "recall", "pct", 0.05, 0.30, 0.20),
    ("risk_guard", 1, "lift", "lift", -3.0, 3.0, 0.25), ("risk_guard", 1, "assessment", "score", 0.0, 0.0, 0.25),
    ("risk_guard", 2, "precision", "pct", 0.40, 0.75, 0.35), ("risk_guard", 2, "blocked_beat", "line", 95.0, -95.0, 0.35), ("risk_guard", 2, "lift", "lift", -3.0, 3.0, 0.35),
    ("risk_guard", 2, "assessment", "score", 0.0, 0.0, 0.30),
    ("exit_rules", 1, "capture", "ratio", 0.70, 0.0, 0.40), ("exit_rules", 1, "avg_return", "lift", -5.0, 5.0, 0.30),
    ("exit_rules", 1, "diagnosis", "score", 0.0, 0.0, 0.30),
    ("position_sizing", 1, "sharpe_diff", "lift", -0.3, 0.5, 0.55), ("position_sizing", 1, "alpha_diff", "lift", -2.0, 3.0, 0.45),
    ("portfolio", 1, "accuracy_10d", "pct", 0.45, 0.70, 0.30), ("portfolio", 1, "avg_alpha", "lift", -2.0, 4.0, 0.25),
    ("portfolio", 1, "sharpe", "line", 30.0, 32.5, 0.25), ("portfolio", 1, "max_drawdown", "line", 95.0, 2.83, 0.20),
]
# Numbers the first rule set of a component cannot do without.
NEEDED = {"scanner": ["precision", "recall"], "team": ["precision", "recall"], "committee": ["precision", "recall"],
          "veto_gate": ["recall"], "risk_guard": ["recall"]}
# Share of each component in its module, and of each module in the total.
MODULES = {
    "research": {"scanner": 0.10, "team": 0.30, "macro": 0.10, "committee": 0.25, "composite": 0.25},
    "predictor": {"meta_model": 0.55, "veto_gate": 0.45},
    "executor": {"entry_triggers": 0.15, "risk_guard": 0.20, "exit_rules": 0.20, "position_sizing": 0.15, "portfolio": 0.30},
}
OVERALL = {"research": 0.40, "predictor": 0.25, "executor": 0.35}
# Marks for verdicts in words.
ASSESSMENT = {"appropriate": 80.0, "too_tight": 45.0, "too_loose": 35.0, "neutral": 55.0}
DIAGNOSIS = {"exits_well_timed": 85.0, "exits_could_improve": 55.0, "exits_too_early": 35.0}


def metric_rows(df: DataFrame, component, metrics: dict[str, object], item=None) -> DataFrame:
    """Result columns (or column expressions) as metric rows."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), (F.col(c) if isinstance(c, str) else c).cast("double").alias("value"))
        for m, c in metrics.items()])).alias("x")
    key = F.lit("") if item is None else F.col(item)
    return df.select(F.lit(component).alias("component"), key.alias("item"), pairs).select(
        "component", "item", "x.metric", "x.value")


def words(column: str, marks: dict[str, float]):
    return reduce(lambda acc, kv: acc.when(F.col(column) == kv[0], kv[1]), list(marks.items())[1:],
                  F.when(F.col(column) == next(iter(marks)), next(iter(marks.values()))))


def component_grades(metrics: DataFrame) -> DataFrame:
    """(component, item, grade, letter): each metric through its rule, weighted mean of what is known.

    One aggregate: both rule sets of a component are summed side by side and the one that applies is chosen at the end,
    so the metrics are read once.
    """
    rules = metrics.sparkSession.createDataFrame(
        [(*rule, rule[1] == 1 and rule[2] in NEEDED.get(rule[0], []), len(NEEDED.get(rule[0], []))) for rule in RULES],
        "component string, rule_set int, metric string, kind string, a double, b double, weight double, needed boolean, n_needed int")
    v, a, b = F.col("value"), F.col("a"), F.col("b")
    grade = (
        F.when(F.col("kind") == "pct", pct_grade(v, a, b)).when(F.col("kind") == "lift", lift_grade(v, a, b))
        .when(F.col("kind") == "line", clamp(a + v * b, 0, 100)).when(F.col("kind") == "ratio", ratio_grade(v, a))
        .otherwise(v))
    d = metrics.join(F.broadcast(rules), ["component", "metric"], "left").withColumn("__g", F.when(v.isNotNull(), grade))
    mean = lambda n: weighted_average(F.when(F.col("rule_set") == n, F.col("weight")),
                                      F.when(F.col("rule_set") == n, F.col("__g")))
    complete = F.count_if(F.col("needed") & v.isNotNull()) >= F.coalesce(F.max("n_needed"), F.lit(0))
    return d.groupBy("component", "item").agg(
        rnd(F.when(complete, mean(1)).otherwise(mean(2)), 6).alias("grade")).withColumn("letter", letter("grade"))


def component_means(grades: DataFrame) -> DataFrame:
    """(component, grade): teams and triggers count by their mean."""
    return grades.groupBy("component").agg(F.avg("grade").alias("grade"))


def scorecard(means: DataFrame) -> DataFrame:
    """(level, name, grade, letter, status): components in modules, modules in the total, one chain of aggregates."""
    weights = means.sparkSession.createDataFrame(
        [(m, OVERALL[m], c, w) for m, cs in MODULES.items() for c, w in cs.items()],
        "module string, share double, component string, weight double")
    parts = weights.join(F.broadcast(means), "component", "left")  # a row per component of the rule table at most
    modules = parts.groupBy("module", "share").agg(rnd(weighted_average("weight", "grade"), 6).alias("grade"))
    levels = F.explode(F.array(
        F.struct(F.lit("module").alias("level"), F.col("module").alias("name")),
        F.struct(F.lit("overall").alias("level"), F.lit("overall").alias("name")))).alias("x")
    own, n = F.col("level") == "module", F.count("grade")
    status = F.when(n == 0, "insufficient_data").when(n < len(OVERALL), "partial").otherwise("ok")
    return modules.select(levels, "share", "grade").select("x.*", "share", "grade").groupBy("level", "name").agg(
        F.when(own, F.max("grade")).otherwise(rnd(weighted_average("share", "grade"), 6)).alias("grade"),
        F.when(~own, status).alias("status"),
    ).withColumn("letter", letter("grade"))
