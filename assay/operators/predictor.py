"""Predictions against outcomes: veto gate, confusion, health, calibration, drift, sizing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.aggregates import pearson
from assay.functions.frames import with_scalars
from assay.functions.ranks import numbered_by_id, spearman, with_average_rank
from assay.functions.scalars import (
    bucket_right_open, direction_of, drift_class, net_signal, ratio, rnd, wilson_bounds,
)
from assay.operators.asof import asof_backward

CONFIDENCES = [0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80]
COST_WEIGHTS = [0.15, 0.30, 0.50, 0.70]
DIRECTIONS = ["UP", "FLAT", "DOWN"]
REGIMES = ["bull", "neutral", "bear", "caution"]
RELIABILITY_BINS = [("0.5-0.6", 0.5, 0.6), ("0.6-0.7", 0.6, 0.7), ("0.7-0.8", 0.7, 0.8),
                    ("0.8-0.9", 0.8, 0.9), ("0.9-1.0", 0.9, 1.01)]


def _all():
    """One window over everything: only ever used over small result tables."""
    return Window.partitionBy(F.lit(0))


def _day(asof) -> Column:
    return F.lit(asof).cast("date") if isinstance(asof, str) else asof


# --- veto gate ---------------------------------------------------------------

def nearest_prediction(signals: DataFrame, predictions: DataFrame) -> DataFrame:
    """Resolved signals with the symbol's latest prediction on or before the score date."""
    resolved = signals.filter(F.col("beat_spy_10d").isNotNull())
    return asof_backward(resolved, predictions, ["symbol"], "score_date", "prediction_date",
                         ["predicted_direction", "prediction_confidence"])


def direction_distribution(matched: DataFrame) -> DataFrame:
    return matched.filter(F.col("matched_date").isNotNull()).groupBy(
        F.coalesce("predicted_direction", F.lit("UNKNOWN")).alias("direction")).agg(F.count("*").alias("n"))


def down_rows(matched: DataFrame) -> DataFrame:
    return matched.filter(F.col("predicted_direction") == "DOWN")


def veto_thresholds(matched: DataFrame, thresholds: list[float] = CONFIDENCES) -> DataFrame:
    """What a veto at confidence >= T would have caught; T without a veto keeps a zero row.

    Rows are summed once under the highest threshold they reach; the cumulative
    sums then run over one row per threshold.
    """
    ordered = sorted(thresholds)
    reached = reduce(
        lambda acc, t: acc.when(F.col("prediction_confidence") >= t, t), ordered[-2::-1],
        F.when(F.col("prediction_confidence") >= ordered[-1], ordered[-1]))
    lost, won = F.col("beat_spy_10d") == 0, F.col("beat_spy_10d") == 1
    down = down_rows(matched)
    parts = down.groupBy(reached.alias("confidence")).agg(
        F.count("*").alias("n_vetoes"), F.count_if(lost).alias("true_negatives"),
        F.count_if(won).alias("false_negatives"),
        F.coalesce(F.sum(F.when(won, F.col("return_10d"))), F.lit(0.0)).alias("missed"))
    spine = matched.sparkSession.createDataFrame([(t,) for t in ordered], "confidence double")
    # rows below every threshold still count as losers the gate did not catch
    all_rows = spine.join(F.broadcast(parts), "confidence", "full")
    cum = Window.orderBy(F.col("confidence").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    sums = ["n_vetoes", "true_negatives", "false_negatives", "missed"]
    table = all_rows.select(
        "confidence", F.sum("true_negatives").over(_all()).alias("losers"),
        *[F.coalesce(F.sum(c).over(cum), F.lit(0)).alias(c) for c in sums],
    ).filter(F.col("confidence").isNotNull())
    base = matched.agg(F.avg("beat_spy_10d").alias("base_rate"))
    n, tn = F.col("n_vetoes"), F.col("true_negatives")
    precision, recall = ratio(tn, n), F.when(n > 0, ratio(tn, F.col("losers")))
    lo, hi = wilson_bounds(tn, n)
    return with_scalars(table, base).select(
        "confidence", "n_vetoes", "true_negatives", "false_negatives",
        rnd(precision, 4).alias("precision"), rnd(recall, 4).alias("recall"),
        rnd(F.try_divide(2 * precision * recall, precision + recall), 4).alias("f1"),
        F.when(n > 0, lo).alias("ci_low"), F.when(n > 0, hi).alias("ci_high"),
        (n < 30).alias("low_confidence"), rnd("missed", 4).alias("missed_alpha"),
        rnd(F.coalesce(ratio(F.col("missed"), F.col("false_negatives")), F.lit(0.0)), 4)
        .alias("missed_alpha_per_winner"),
        rnd(precision - F.col("base_rate"), 4).alias("lift"), rnd("base_rate", 4).alias("base_rate"),
    )


def select_veto_threshold(table: DataFrame, current: float = 0.60, cost_weight: float = 0.30,
                          min_vetoes: int = 10, min_lift: float = 0.05) -> DataFrame:
    """Best precision less the cost of missed winners; how much the choice depends
    on the price of a miss; status of the recommendation.  One row."""
    ok = F.col("n_vetoes") >= min_vetoes
    top = F.max(F.when(ok, F.abs("missed_alpha"))).over(_all())
    cost = F.abs("missed_alpha") / F.when(top > 0, top).otherwise(1.0)
    weights = [cost_weight, *COST_WEIGHTS]
    scored = table.withColumn("__ok", ok).withColumn("__cost", cost)

    def pick(w: float, col: str) -> Column:
        score = F.when(F.col("__ok"), F.struct(F.col("precision") - w * F.col("__cost"), -F.col("confidence")))
        return F.max_by(col, score)

    row = scored.agg(
        F.count_if("__ok").alias("n_scoreable"), F.first("base_rate").alias("base_rate"),
        *[pick(w, "confidence").alias(f"__c{i}") for i, w in enumerate(weights)],
        *[pick(cost_weight, c).alias(c) for c in ("precision", "lift", "missed_alpha", "n_vetoes", "recall")],
    )
    choices = F.size(F.array_distinct(F.array(*[f"__c{i}" for i in range(1, len(weights))])))
    usable = F.col("n_scoreable") > 0
    status = F.when(~usable, "insufficient_vetoes").when(F.col("lift") < min_lift, "insufficient_lift").otherwise("ok")
    return row.select(
        status.alias("status"), F.lit(current).alias("current_threshold"), "base_rate",
        F.when(usable, F.col("__c0")).alias("recommended_threshold"),
        *[F.when(usable, F.col(c)).alias(c) for c in ("precision", "recall", "lift", "missed_alpha", "n_vetoes")],
        F.when(usable, F.when(choices > 2, "high").when(choices == 1, "low").otherwise("moderate"))
        .alias("cost_sensitivity"),
    )


def veto_by_sector(matched: DataFrame, threshold: float) -> DataFrame:
    hit = F.col("prediction_confidence") >= threshold
    lost = F.col("beat_spy_10d") == 0
    rows = down_rows(matched).filter(F.col("sector").isNotNull()).groupBy("sector").agg(
        F.count("*").alias("n_down"), F.count_if(hit).alias("n_vetoes"),
        F.count_if(hit & lost).alias("__tn"), F.count_if(lost).alias("__lost"))
    some = F.col("n_vetoes") > 0
    return rows.select(
        "sector", "n_down", "n_vetoes", rnd(ratio(F.col("__tn"), F.col("n_vetoes")), 4).alias("precision"),
        rnd(F.when(some, ratio(F.col("__tn"), F.col("__lost"))), 4).alias("recall"))


# --- direction ---------------------------------------------------------------

def confusion_matrix(predictions: DataFrame, band: float = 0.005) -> DataFrame:
    """Counts of predicted against actual direction; all nine cells are present."""
    seen = (
        predictions.filter(F.col("predicted_direction").isNotNull() & F.col("actual_5d_return").isNotNull())
        .groupBy(F.col("predicted_direction").alias("predicted"), direction_of("actual_5d_return", band).alias("actual"))
        .agg(F.count("*").alias("n"))
    )
    spine = predictions.sparkSession.createDataFrame(
        [(p, a) for p in DIRECTIONS for a in DIRECTIONS], "predicted string, actual string")
    return spine.join(seen, ["predicted", "actual"], "left").select(
        "predicted", "actual", F.coalesce("n", F.lit(0)).alias("n"))


def direction_rates(predictions: DataFrame, band: float = 0.005, min_samples: int = 30) -> DataFrame:
    """Precision, recall and F1 per direction from row and column sums of one cube."""
    known = predictions.filter(
        F.col("predicted_direction").isNotNull() & F.col("actual_5d_return").isNotNull())
    cube = (
        known.select(F.col("predicted_direction").alias("p"), direction_of("actual_5d_return", band).alias("a"))
        .cube("p", "a").agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    )
    g = lambda i: F.col("g") == i
    whole = cube.agg(F.sum(F.when(g(3), F.col("n"))).alias("__n"),
                     F.coalesce(F.sum(F.when(g(0) & (F.col("p") == F.col("a")), F.col("n"))), F.lit(0)).alias("__diag"))
    label = F.when(g(1), F.col("p")).when(g(2), F.col("a")).when(g(0) & (F.col("p") == F.col("a")), F.col("p"))
    sums = cube.groupBy(label.alias("direction")).agg(
        F.sum(F.when(g(1), F.col("n"))).alias("n_predicted"), F.sum(F.when(g(2), F.col("n"))).alias("n_actual"),
        F.sum(F.when(g(0), F.col("n"))).alias("tp"))
    spine = predictions.sparkSession.createDataFrame([(x,) for x in DIRECTIONS], "direction string")
    rows = with_scalars(spine.join(sums, "direction", "left"), whole).fillna(
        0, ["n_predicted", "n_actual", "tp"])
    precision, recall = ratio(F.col("tp"), F.col("n_predicted")), ratio(F.col("tp"), F.col("n_actual"))
    return rows.filter(F.col("__n") >= min_samples).select(
        "direction", rnd(precision, 4).alias("precision"), rnd(recall, 4).alias("recall"),
        rnd(F.try_divide(2 * precision * recall, precision + recall), 4).alias("f1"),
        "n_predicted", "n_actual", "tp", rnd(ratio(F.col("__diag"), F.col("__n")), 4).alias("accuracy"))


# --- macro shift -------------------------------------------------------------

def macro_evaluation(committee: DataFrame, universe: DataFrame, threshold: float = 60.0,
                     min_samples: int = 10) -> DataFrame:
    """Accuracy and alpha of the picks with and without the macro shift, and what it moved."""
    keys = ["ticker", "eval_date"]
    outcome = universe.filter(F.col("return_5d").isNotNull()).select(*keys, "return_5d", "spy_return_5d", "beat_spy_5d")
    return macro_of(committee.join(outcome, keys), threshold, min_samples)


def macro_of(resolved: DataFrame, threshold: float = 60.0, min_samples: int = 10) -> DataFrame:
    """``macro_evaluation`` where the committee's rows carry their outcome already."""
    m = resolved.filter(F.col("combined_score").isNotNull() & F.col("final_score").isNotNull()).withColumn(
        "alpha", F.col("return_5d") - F.col("spy_return_5d"))
    on, off = F.col("final_score") >= threshold, F.col("combined_score") >= threshold
    s = F.col("macro_shift")
    up, down = on & ~off, off & ~on
    row = m.agg(
        F.count("*").alias("n_evaluated"),
        rnd(F.avg(F.when(on, F.col("beat_spy_5d"))), 4).alias("with_accuracy"),
        rnd(F.avg(F.when(on, F.col("alpha"))), 4).alias("with_alpha"), F.count_if(on).alias("with_n"),
        rnd(F.avg(F.when(off, F.col("beat_spy_5d"))), 4).alias("without_accuracy"),
        rnd(F.avg(F.when(off, F.col("alpha"))), 4).alias("without_alpha"), F.count_if(off).alias("without_n"),
        rnd(F.avg(s), 4).alias("avg_shift"), F.max(s).alias("max_shift"), F.min(s).alias("min_shift"),
        rnd(F.stddev_samp(s), 4).alias("std_shift"), F.count_if(s > 0).alias("n_positive"),
        F.count_if(s < 0).alias("n_negative"), F.count_if(s == 0).alias("n_zero"),
        F.count_if(up).alias("n_promoted"), F.count_if(down).alias("n_demoted"),
        rnd(F.avg(F.when(up, F.col("alpha"))), 4).alias("promoted_avg_alpha"),
        rnd(F.avg(F.when(down, F.col("alpha"))), 4).alias("demoted_avg_alpha"),
    )
    lift = rnd(F.col("with_accuracy") - F.col("without_accuracy"), 4)
    return row.withColumn("accuracy_lift", lift).withColumn(
        "alpha_lift", rnd(F.col("with_alpha") - F.col("without_alpha"), 4)).withColumn(
        "assessment", F.when(F.col("accuracy_lift").isNull(), "insufficient_data")
        .when(F.col("accuracy_lift") > 0.02, "helps").when(F.col("accuracy_lift") < -0.02, "hurts")
        .otherwise("neutral")).filter(F.col("n_evaluated") >= min_samples)


# --- production health ---------------------------------------------------------

def recent_resolved(outcomes: DataFrame, asof, lookback_days: int) -> DataFrame:
    return outcomes.filter(F.col("correct_5d").isNotNull()
                           & (F.col("prediction_date") >= F.date_sub(_day(asof), lookback_days)))


def production_health(outcomes: DataFrame, asof, training_ic: float, lookback_days: int = 30,
                      min_samples: int = 10, degraded_below: float = 0.5, collapse_above: float = 0.75) -> DataFrame:
    d = F.col("predicted_direction")
    net, actual = net_signal("p_up", "p_down"), F.col("actual_5d_return").try_cast("double")
    row = recent_resolved(outcomes, asof, lookback_days).agg(
        F.count("*").alias("n_resolved"), rnd(pearson(net, actual, min_samples), 4).alias("rolling_ic"),
        rnd(F.avg(F.col("correct_5d").try_cast("double")), 4).alias("hit_rate"),
        *[rnd(ratio(F.count_if(d == x), F.count(d)), 3).alias(f"share_{x.lower()}") for x in DIRECTIONS])
    usable = F.lit(training_ic if training_ic > 0 else None).cast("double")
    row = row.withColumn("training_ic", F.lit(float(training_ic))).withColumn(
        "ic_ratio", rnd(F.try_divide(F.col("rolling_ic"), usable), 2))
    return row.withColumn("degradation_flag", F.coalesce(F.col("ic_ratio") < degraded_below, F.lit(False))) \
        .withColumn("mode_collapse_flag", F.greatest("share_up", "share_flat", "share_down") > collapse_above) \
        .filter(F.col("n_resolved") >= min_samples)


def regime_ic(outcomes: DataFrame, regimes: DataFrame, asof, lookback_days: int = 30,
              min_samples: int = 10) -> DataFrame:
    """IC per market regime; NULL below the sample gate; the four regimes are always there."""
    r = regimes.select(F.col("date").alias("prediction_date"), F.col("market_regime").alias("regime"))
    actual = F.col("actual_5d_return").try_cast("double")
    ic = recent_resolved(outcomes, asof, lookback_days).join(r, "prediction_date").groupBy("regime").agg(
        F.count(actual).alias("n"), rnd(pearson(net_signal("p_up", "p_down"), actual, min_samples), 4).alias("ic"))
    spine = outcomes.sparkSession.createDataFrame([(x,) for x in REGIMES], "regime string")
    return spine.join(ic, "regime", "left").select(
        "regime", F.coalesce("n", F.lit(0)).alias("n"), "ic")


def calibration_bins(outcomes: DataFrame, asof, lookback_days: int = 60, min_bin: int = 10) -> DataFrame:
    """Hit rate against mean confidence per confidence bin."""
    conf, ok = F.col("prediction_confidence").try_cast("double"), F.col("correct_5d").try_cast("double")
    rows = (
        recent_resolved(outcomes, asof, lookback_days)
        .filter(conf.isNotNull() & ok.isNotNull())
        .groupBy(bucket_right_open(conf, RELIABILITY_BINS).alias("bin"))
        .agg(F.count("*").alias("n"), F.avg(ok).alias("hit_rate"), F.avg(conf).alias("expected"))
        .filter(F.col("bin").isNotNull())
    )
    return rows.withColumn("used", F.col("n") >= min_bin)


def calibration_table(bins: DataFrame) -> DataFrame:
    return bins.select("bin", "n", rnd("hit_rate", 3).alias("hit_rate"), rnd("expected", 3).alias("expected"), "used")


def calibration_summary(bins: DataFrame) -> DataFrame:
    """Expected calibration error over the bins with enough rows."""
    n = F.when(F.col("used"), F.col("n"))
    row = bins.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n_total"), F.count_if("used").alias("n_bins"),
        F.count_if(~F.col("used")).alias("n_dropped"),
        rnd(ratio(F.sum(F.abs(F.col("hit_rate") - F.col("expected")) * n), F.sum(n)), 4).alias("overall_ece"))
    e = F.col("overall_ece")
    return row.withColumn("calibration_quality", F.when(e.isNull(), "unknown").when(e < 0.05, "good")
                          .when(e < 0.10, "acceptable").otherwise("poor"))


def rolling_metrics(outcomes: DataFrame, asof, id_col: str = "id", lookback_days: int = 30,
                    least: int = 5, least_ic: int = 10) -> DataFrame:
    """Hit rate, IC, and the IC's mean over its spread across consecutive chunks.

    Rows are in id order (order of insertion); the remainder that does not fill
    a chunk is left out of the chunk statistics.
    """
    recent = recent_resolved(outcomes, asof, lookback_days)
    net, actual = net_signal("p_up", "p_down"), F.col("actual_5d_return").try_cast("double")
    totals = recent.agg(F.count("*").alias("rolling_n"), rnd(F.avg("correct_5d"), 4).alias("hit_rate"),
                        rnd(pearson(net, actual, least_ic), 4).alias("ic"))
    valid = recent.filter(actual.isNotNull()).select(id_col, net.alias("x"), actual.alias("y"))
    numbered = numbered_by_id(valid, id_col)
    chunks = F.greatest(F.lit(2), F.floor(F.col("row_no_total") / 5))
    size = F.floor(F.col("row_no_total") / chunks)
    per_chunk = (
        numbered.withColumn("chunk", F.floor(F.col("row_no") / size)).filter(F.col("chunk") < chunks)
        .groupBy("chunk").agg(pearson("x", "y").alias("c"), F.max("row_no_total").alias("m"))
    )
    ir = per_chunk.agg(F.count("*").alias("n_chunks"), rnd(F.when(
        F.max("m") >= least_ic, F.avg("c") / (F.stddev_pop("c") + 1e-8)), 3).alias("ic_ir"))
    return with_scalars(totals, ir).filter(F.col("rolling_n") >= least)


# --- feature drift -------------------------------------------------------------

def outcomes_with_features(outcomes: DataFrame, features: DataFrame, feature_cols: list[str],
                           order_col: str | None = None) -> DataFrame:
    """Each outcome with the symbol's feature row of that day, else the latest before it."""
    f = features.withColumnRenamed("ticker", "symbol")
    joined = asof_backward(outcomes, f, ["symbol"], "prediction_date", "date", feature_cols, tie=order_col)
    return joined.filter(F.col("matched_date").isNotNull())


def feature_ics(joined: DataFrame, feature_cols: list[str], min_samples: int = 20,
                by: list[str] | None = None) -> DataFrame:
    """(feature, n, ic): rank correlation of every feature with the outcome, within
    the groups of ``by`` (a period, say), all in one pass."""
    by = by or []
    long = joined.select(
        *by, F.col("actual_5d_return").cast("double").alias("y"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                            for c in feature_cols])).alias("f"),
    ).select(*by, "f.feature", "f.x", "y")
    return spearman(long, [*by, "feature"], "x", "y").filter(F.col("n") >= min_samples).select(
        *by, "feature", "n", rnd("rank_ic", 6).alias("ic"))


def feature_drift(production: DataFrame, training: DataFrame) -> DataFrame:
    """Features whose relation to the outcome changed, worst drop first by ``ic_drop``."""
    t = training.select("feature", F.col("ic").alias("training_ic"))
    rows = production.join(t.filter(F.col("training_ic").isNotNull()), "feature")
    return rows.select(
        "feature", rnd("training_ic", 6).alias("training_ic"), F.col("ic").alias("production_ic"),
        drift_class("training_ic", "ic").alias("status"),
        rnd(F.col("training_ic") - F.col("ic"), 6).alias("ic_drop"))


def drift_summary(drift: DataFrame, retrain_above: float = 0.20) -> DataFrame:
    drifted = F.col("status") != "stable"
    row = drift.agg(F.count_if(drifted).alias("n_drifted"), F.count_if(~drifted).alias("stable_features"),
                    F.count("*").alias("total_features"))
    share = F.coalesce(ratio(F.col("n_drifted"), F.col("total_features")), F.lit(0.0))
    return row.withColumn("drift_fraction", rnd(share, 3)).withColumn(
        "recommendation", F.when(share > retrain_above, "retrain_suggested")
        .when(F.col("n_drifted") > 0, "monitor").otherwise("stable"))


# --- sizing by p_up --------------------------------------------------------------

def year_week(d) -> Column:
    """Calendar year with ISO week number (the two can disagree around New Year)."""
    return F.concat(F.year(d).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def weekly_rank_ic(outcomes: DataFrame, least: int = 5) -> DataFrame:
    rows = outcomes.filter(F.col("p_up").isNotNull() & F.col("actual_5d_return").isNotNull()).select(
        year_week("prediction_date").alias("week"), "p_up", "actual_5d_return")
    return spearman(rows, ["week"], "p_up", "actual_5d_return").filter(F.col("n") >= least).select(
        "week", rnd("rank_ic", 4).alias("ic"), "n")


def last_weeks(weekly: DataFrame, n: int = 12) -> DataFrame:
    return weekly.orderBy(F.col("week").desc()).limit(n)


def predictor_sizing(outcomes: DataFrame, min_samples: int = 30, min_ic: float = 0.05,
                     min_positive: int = 6, rolling: int = 8) -> DataFrame:
    """Should positions be sized by p_up?  Rank IC overall and by week, and the
    return of rank-weighted against equal weights."""
    d = outcomes.filter(F.col("p_up").isNotNull() & F.col("actual_5d_return").isNotNull()).select(
        "prediction_date", "p_up", "actual_5d_return")
    overall = spearman(d, [], "p_up", "actual_5d_return").select(
        F.col("n").alias("n_samples"), F.col("rank_ic").alias("overall"))
    weekly = weekly_rank_ic(d)
    recent = F.row_number().over(_all().orderBy(F.col("week").desc())) <= rolling  # one row per week
    weeks = weekly.withColumn("__recent", recent).agg(
        F.count_if(F.col("ic") > 0).alias("total_positive_weeks"), F.count("*").alias("total_weeks"),
        F.count_if(F.col("__recent") & (F.col("ic") > 0)).alias("recent_positive_weeks"),
        F.count_if("__recent").alias("recent_total_weeks"),
        F.coalesce(F.avg(F.when(F.col("__recent"), F.col("ic"))), F.lit(0.0)).alias("recent"))
    ranked = with_average_rank(d, ["prediction_date"], "p_up", "rk")
    returns = ranked.agg(
        F.avg(F.col("rk") / F.col("rk_n") * F.col("actual_5d_return")).alias("w"),
        F.avg("actual_5d_return").alias("e"))
    row = with_scalars(overall, weeks, returns)
    enable = (
        (F.col("overall") >= min_ic) & (F.col("recent") >= min_ic)
        & (F.col("recent_positive_weeks") >= F.least(F.lit(min_positive), F.col("recent_total_weeks"))))
    return row.filter(F.col("n_samples") >= min_samples).select(
        "n_samples", rnd("overall", 4).alias("overall_rank_ic"), rnd("recent", 4).alias("recent_mean_ic"),
        "recent_positive_weeks", "recent_total_weeks", "total_positive_weeks", "total_weeks",
        rnd(F.col("w") - F.col("e"), 6).alias("sizing_lift"), rnd("e", 6).alias("equal_weight_return"),
        rnd("w", 6).alias("weighted_return"),
        F.when(enable, "enable").otherwise("keep_disabled").alias("recommendation"))


# --- scanner leakage --------------------------------------------------------------

def _scanned(scanner: DataFrame, universe: DataFrame) -> DataFrame:
    return scanner.join(universe.select("ticker", "eval_date", "return_5d", "beat_spy_5d"),
                        ["ticker", "eval_date"], "left")


def gate_leakage(scanner: DataFrame, universe: DataFrame, tech_floor: float = 60.0) -> DataFrame:
    """Share of the stocks each gate rejected that went on to beat the benchmark."""
    gates = []
    if "liquidity_pass" in scanner.columns:
        gates.append(("liquidity_pass", F.col("liquidity_pass") == 0))
    for name in ("volatility_gate_pass", "volatility_pass"):
        if name in scanner.columns:
            gates.append((name, F.col(name) == 0))
            break
    if "tech_score" in scanner.columns:
        gates.append(("tech_score", F.col("tech_score") < tech_floor))
    rejected = F.array_compact(F.array(*[F.when(c, F.lit(g)) for g, c in gates]))
    rows = _scanned(scanner, universe).filter(F.col("beat_spy_5d").isNotNull())
    return rows.withColumn("gate", F.explode(rejected)).groupBy("gate").agg(
        F.count("*").alias("n_rejected"), rnd(F.avg("beat_spy_5d"), 4).alias("leakage_rate"),
        rnd(F.avg("return_5d"), 4).alias("avg_return_5d"))


def scanner_leakage(scanner: DataFrame, universe: DataFrame, threshold: float = 0.15, min_weeks: int = 8) -> DataFrame:
    return leakage_of(scanner, _scanned(scanner, universe), threshold, min_weeks)


def leakage_of(scanner: DataFrame, scanned: DataFrame, threshold: float = 0.15, min_weeks: int = 8) -> DataFrame:
    """``scanner_leakage`` where the scanner's rows carry their outcome, or NULLs, already."""
    weeks = scanner.select("eval_date").distinct().agg(F.count("*").alias("n_weeks"))
    passed, rejected = F.col("quant_filter_pass") == 1, F.col("quant_filter_pass") == 0
    row = scanned.agg(
        F.count("*").alias("n_total_stocks"), F.count_if(passed).alias("n_passed"),
        F.count_if(rejected).alias("n_rejected"),
        F.coalesce(F.avg(F.when(rejected, F.col("beat_spy_5d"))),
                   F.when(F.count_if(rejected) == 0, 0.0)).alias("__leak"),
        rnd(F.avg(F.when(passed, F.col("return_5d"))) - F.avg("return_5d"), 4).alias("filter_lift"))
    return with_scalars(weeks, row).filter(F.col("n_weeks") >= min_weeks).select(
        "n_weeks", "n_total_stocks", "n_passed", "n_rejected", rnd("__leak", 4).alias("leakage_rate"),
        F.lit(threshold).alias("leakage_threshold"), "filter_lift",
        (F.col("__leak") > threshold).alias("high_leakage"))


def gates_to_relax(gates: DataFrame, summary: DataFrame) -> DataFrame:
    """Gates that leak more than the limit, provided the scanner as a whole does."""
    s = summary.filter("high_leakage").select("leakage_threshold")
    return with_scalars(gates, s).filter(F.col("leakage_rate") > F.col("leakage_threshold")).select(
        "gate", F.col("leakage_rate").alias("current_leakage"), F.lit("relax").alias("action"))


# --- boosts -------------------------------------------------------------------

def boost_correlations(joined: DataFrame, boosts: list[str], least: int = 20) -> DataFrame:
    """Correlation of each boost with beating the benchmark; one pass, one row per boost."""
    aggs = []
    for b in boosts:
        v = F.col(b).cast("double")
        aggs.append(F.struct(
            F.lit(b).alias("boost"),
            F.count_if(v.isNotNull() & F.col("beat_spy_10d").isNotNull()).alias("n"),
            F.count_if(v != 0).alias("n_nonzero"), rnd(F.avg(F.when(v != 0, v)), 4).alias("mean_nonzero"),
            rnd(pearson(v, "beat_spy_10d", least), 6).alias("r_10d"),
            rnd(pearson(v, "beat_spy_30d", least), 6).alias("r_30d")).alias(b))
    return joined.agg(*aggs).select(F.explode(F.array(*boosts)).alias("x")).select("x.*")


