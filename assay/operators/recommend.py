"""Recommendations made from result tables.

Inputs are statistics per combination, variant, trigger, team or parameter:
tables of at most a few hundred rows, so windows over all rows are cheap here.
The one exception, the time-ordered split, works on raw signals and is built to
stay distributed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.aggregates import pearson
from assay.functions.frames import with_scalars
from assay.functions.scalars import hit_probability, ratio, rnd
from assay.operators.portfolio import nav_statistics

PAST = Window.unboundedPreceding
SUB_SCORES = ("quant", "qual")
TARGETS = ("beat_spy_10d", "beat_spy_30d")


def _all():
    return Window.partitionBy(F.lit(0))


# --- parameter grids -----------------------------------------------------------

def seed_grid(values: DataFrame, current: DataFrame) -> DataFrame:
    """Grid values plus the current value of every parameter the grid knows."""
    known = current.join(values.select("param").distinct(), "param", "left_semi")
    return values.select("param", "value").unionByName(known.select("param", "value")).distinct()


def parameter_grid(values: DataFrame, params: list[str]) -> DataFrame:
    """Every combination of the listed values: one row of value lists, exploded
    parameter by parameter."""
    lists = values.filter(F.col("param").isin(params)).agg(*[
        F.array_sort(F.collect_set(F.when(F.col("param") == p, F.col("value")))).alias(p) for p in params])
    for p in params:
        lists = lists.withColumn(p, F.explode(p))
    return lists


def sampled_grid(grid: DataFrame, params: list[str], trials: int, seed: int = 42) -> DataFrame:
    """``trials`` distinct combinations in an order drawn from the seed; all of them
    when the grid is not larger."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(p).cast("string") for p in params]))
    return grid.withColumn("draw", key).orderBy("draw", *params).limit(trials)


def sweep_coverage(grid: DataFrame, sample: DataFrame) -> DataFrame:
    row = with_scalars(grid.agg(F.count("*").alias("n_grid")), sample.agg(F.count("*").alias("n_trials")))
    return row.withColumn("coverage", rnd(ratio(F.col("n_trials"), F.col("n_grid")), 4)).withColumn(
        "mode", F.when(F.col("n_trials") < F.col("n_grid"), "random").otherwise("grid")).withColumn(
        "hit_probability", rnd(hit_probability("n_trials"), 6))


def sweep_results(combos: DataFrame, stats: DataFrame) -> DataFrame:
    """Parameters with statistics; a combination without any keeps its row and an error.
    Best alpha first."""
    names = [c for c in stats.columns if c not in combos.columns]
    d = combos.join(stats.select("combo_id", *names), "combo_id", "left")
    return d.withColumn("error", F.when(F.col("sharpe_ratio").isNull(), "no result")).orderBy(
        F.col("total_alpha").desc_nulls_last(), F.col("sharpe_ratio").desc_nulls_last(), "combo_id")


def sweep_completion(results: DataFrame, limit: float = 0.5) -> DataFrame:
    row = results.agg(F.count("*").alias("n_total"), F.count_if(F.col("error").isNull()).alias("n_valid"))
    share = F.coalesce(ratio(F.col("n_valid"), F.col("n_total")), F.lit(0.0))
    return row.withColumn("completion", rnd(share, 4)).withColumn("low_completion", share < limit)


def best_parameters(results: DataFrame, metric: str = "sharpe_ratio") -> DataFrame:
    """First row, in result order, that has the metric."""
    return results.filter(F.col(metric).isNotNull()).orderBy(
        F.col("total_alpha").desc_nulls_last(), F.col("sharpe_ratio").desc_nulls_last(), "combo_id").limit(1)


# --- combination choice ----------------------------------------------------------

def ranked_combos(stats: DataFrame, params: list[str], current: dict[str, float], penalty: float = 0.5) -> DataFrame:
    """Combined score, its rank, and the distance of each combination to the current parameters."""
    valid = stats.filter(F.col("sharpe_ratio").isNotNull())
    score = F.col("sharpe_ratio") - penalty * F.abs(F.coalesce("max_drawdown", F.lit(0.0)))
    w = _all()
    squares: Column = F.lit(0.0)
    for p in params:
        if p in current:
            x = F.col(p).cast("double")
            span = F.max(x).over(w) - F.min(x).over(w)
            step = F.try_divide(F.coalesce(x, F.lit(0.0)) - float(current[p]), F.when(span != 0, span))
            squares = squares + F.coalesce(step * step, F.lit(0.0))
    d = valid.withColumns({"combined_score": rnd(score, 8), "distance": rnd(F.sqrt(squares), 8)})
    return d.withColumns({
        "rank": F.row_number().over(w.orderBy(F.col("combined_score").desc(), "combo_id")),
        "nearness": F.row_number().over(w.orderBy("distance", F.col("combined_score").desc(), "combo_id")),
    })


def recommend_combo(ranked: DataFrame, completion: DataFrame | None = None, min_combos: int = 5, min_trades: int = 50,
                    min_improvement: float = 0.10) -> DataFrame:
    """Best against baseline (the combination nearest to the current parameters).
    Ranked by combined score, judged by the Sharpe ratio of the chosen row.  One row.
    ``completion`` is the sweep's row of ``sweep_completion``; a sweep that mostly
    failed is not judged."""
    best, base = F.col("rank") == 1, F.col("nearness") == 1
    at = lambda cond, c: F.max(F.when(cond, F.col(c)))
    row = ranked.agg(
        F.count("*").alias("n_combos"), F.max("total_trades").alias("most_trades"),
        at(best, "combo_id").alias("best_combo"), at(base, "combo_id").alias("baseline_combo"),
        at(best, "sharpe_ratio").alias("best_sharpe"), at(base, "sharpe_ratio").alias("baseline_sharpe"),
        at(best, "total_alpha").alias("best_alpha"), at(base, "total_alpha").alias("baseline_alpha"),
        at(base, "rank").alias("baseline_rank"), at(base, "distance").alias("baseline_distance"),
    )
    gain = F.when(F.col("baseline_sharpe") == 0, F.when(F.col("best_sharpe") > 0, float("inf")).otherwise(0.0)).otherwise(
        F.try_divide(F.col("best_sharpe") - F.col("baseline_sharpe"), F.abs("baseline_sharpe")))
    row = row.withColumn("low_completion", F.lit(False)) if completion is None else with_scalars(
        row, completion.select("low_completion"))
    status = (
        F.when(F.col("low_completion") | (F.col("n_combos") < min_combos), "insufficient_data")
        .when(F.col("most_trades") < min_trades, "insufficient_trades")
        .when(F.col("best_sharpe") < 0, "negative_sharpe")
        .when(gain < min_improvement, "no_improvement").otherwise("ok")
    )
    return row.withColumn("improvement", rnd(gain, 4)).withColumn("status", status).drop("low_completion")


def closer_combos(ranked: DataFrame) -> DataFrame:
    """How many combinations lie nearer to the current parameters than the baseline."""
    base = F.min(F.when(F.col("nearness") == 1, F.col("distance"))).over(_all())
    return ranked.withColumn("__b", base).agg(F.count_if(F.col("distance") < F.col("__b")).alias("n_closer_combos"))


def holdout_check(nav: DataFrame, choice: DataFrame, share: float = 0.7, least_dates: int = 3,
                  least_ratio: float = 0.5) -> DataFrame:
    """Sharpe of the chosen combination on the last days against its Sharpe overall."""
    chosen = nav.join(choice.select(F.col("best_combo").alias("combo_id"), F.col("best_sharpe")), "combo_id")
    last = chosen.agg((F.max("pos") + 1).alias("__n"))
    held = with_scalars(chosen, last).filter(F.col("pos") >= F.floor(F.col("__n") * share))
    stats = nav_statistics(held.select("combo_id", "date", "nav"))
    train = choice.select(F.col("best_combo").alias("combo_id"), "best_sharpe", "status")
    d = train.join(stats, "combo_id", "left").withColumn("n_dates", F.coalesce("n_dates", F.lit(0)))
    few = F.col("n_dates") < least_dates
    r = F.when(F.col("best_sharpe") < 0, 0.0).otherwise(F.coalesce(
        ratio(F.col("sharpe_ratio"), F.col("best_sharpe")), F.lit(0.0)))
    passed = few | ((F.col("best_sharpe") >= 0) & (r >= least_ratio) & (F.col("sharpe_ratio") > 0))
    return d.select(
        "combo_id", F.col("n_dates").alias("holdout_dates"), rnd("sharpe_ratio", 4).alias("holdout_sharpe"),
        rnd(F.when(~few, r), 4).alias("holdout_ratio"), passed.alias("holdout_passed"),
        # a choice that was not ok before stays what it was
        F.when(passed | (F.col("status") != "ok"), F.col("status")).otherwise("holdout_failed").alias("status"))


# --- time-ordered split -------------------------------------------------------------

def time_split(signals: DataFrame, share: float, date: str, symbol: str, ties: list[str]) -> DataFrame:
    """Flag the first floor(share * n) rows in (date, symbol, ties) order.

    The cut is found by drilling down: first the date it falls on (one row per
    date), then the symbol within that date, and only rows of that one (date,
    symbol) are numbered.  Each place of the cut is one row and reaches the
    signals as a scalar, so they are neither joined nor shuffled.  A row without
    a date or symbol comes before those with one, as in an ascending order.
    """
    first = lambda c: F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("v"))

    def place(counts: DataFrame, key: str, k: Column, base: Column) -> DataFrame:
        """The one row in which the k-th of all falls, and how many come before it."""
        w = _all().orderBy(key)
        d = counts.withColumns({"__all": k, "__hi": base + F.sum("__c").over(w.rowsBetween(PAST, 0))})
        return d.filter((F.col("__hi") > F.col("__all")) & (F.col("__hi") - F.col("__c") <= F.col("__all"))).select(
            first(key).alias(f"__at_{key}"), (F.col("__hi") - F.col("__c")).alias(f"__lo_{key}"), F.col("__all").alias(f"__k_{key}"))

    cut = F.floor(F.sum("__c").over(_all()) * share + 1e-9)
    on = place(signals.groupBy(date).agg(F.count("*").alias("__c")), date, cut, F.lit(0))
    d = with_scalars(signals, on)
    at_date, at_symbol = F.col(f"__at_{date}"), F.col(f"__at_{symbol}")
    day = d.filter(first(date) == at_date)
    per_symbol = day.groupBy(symbol).agg(
        F.count("*").alias("__c"), F.max(f"__lo_{date}").alias("__base"), F.max(f"__k_{date}").alias("__k"))
    d = with_scalars(d, place(per_symbol, symbol, F.col("__k"), F.col("__base")))
    here = F.coalesce((first(date) == at_date) & (first(symbol) == at_symbol), F.lit(False))
    # without a place for the cut every row is in
    before = (first(date) < at_date) | ((first(date) == at_date) & (first(symbol) < at_symbol))
    cols = [*signals.columns, "in_train"]
    rest = d.filter(~here).withColumn("in_train", F.coalesce(before, F.lit(True)))
    no = F.row_number().over(Window.partitionBy(symbol).orderBy(*ties))
    own = d.filter(here).withColumn("in_train", F.col(f"__lo_{symbol}") + no <= F.col(f"__k_{symbol}"))
    return rest.select(*cols).unionByName(own.select(*cols))


# --- scoring weights ----------------------------------------------------------------

def split_correlations(split: DataFrame, least: int = 10) -> DataFrame:
    """One row: n, n_train, n_test and the correlation per (set, sub-score, target)."""
    aggs = [F.count("*").alias("n"), F.count_if("in_train").alias("n_train"), F.count_if(~F.col("in_train")).alias("n_test")]
    for name, cond in (("train", F.col("in_train")), ("test", ~F.col("in_train"))):
        for s in SUB_SCORES:
            for t in TARGETS:
                aggs.append(pearson(F.when(cond, F.col(f"{s}_score")), F.when(cond, F.col(t)), least).alias(f"{name}_{s}_{t}"))
    return split.agg(*aggs)


def suggest_weights(corr: DataFrame, current: dict[str, float], min_samples: int = 30, min_test: int = 10,
                    blends: tuple[float, float, float] = (0.20, 0.50, 500.0), confidence: tuple[int, int] = (100, 300),
                    max_degradation: float = 0.20) -> DataFrame:
    """Weights pulled from the current ones toward the data, with the out-of-sample check.  One row."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    mixed = {s: F.greatest(F.lit(0.0), 0.5 * zero(f"train_{s}_beat_spy_10d") + 0.5 * zero(f"train_{s}_beat_spy_30d"))
             for s in SUB_SCORES}
    lo, hi, ramp = blends
    d = corr.withColumns({f"__w_{s}": m for s, m in mixed.items()})
    total = reduce(lambda a, b: a + b, [F.col(f"__w_{s}") for s in SUB_SCORES])
    d = d.withColumn("blend", F.least(F.lit(hi), lo + (hi - lo) * (F.col("n_train") / ramp)))
    for s in SUB_SCORES:
        pure = F.coalesce(F.try_divide(F.col(f"__w_{s}"), F.when(total != 0, total)), F.lit(float(current[s])))
        d = d.withColumn(f"__s_{s}", rnd(current[s] * (1 - F.col("blend")) + pure * F.col("blend"), 3))
    both = reduce(lambda a, b: a + b, [F.col(f"__s_{s}") for s in SUB_SCORES])
    size = lambda kind: reduce(lambda a, b: a + b, [
        0.5 * F.abs(zero(f"{kind}_{s}_{t}")) for s in SUB_SCORES for t in TARGETS])
    degradation = F.coalesce(1 - F.try_divide(size("test"), F.when(size("train") > 0, size("train"))), F.lit(0.0))
    enough = (F.col("n") >= min_samples) & (F.col("n_train") >= min_samples) & (F.col("n_test") >= min_test)
    out = d.select(
        F.when(enough, "ok").otherwise("insufficient_data").alias("status"), "n", "n_train", "n_test",
        F.when(F.col("n") >= confidence[1], "high").when(F.col("n") >= confidence[0], "medium").otherwise("low").alias("confidence"),
        rnd("blend", 3).alias("blend_factor"), *[rnd(F.col(f"__s_{s}") / both, 3).alias(f"{s}_weight") for s in SUB_SCORES],
        rnd(degradation, 4).alias("oos_degradation"), (degradation < max_degradation).alias("oos_passed"))
    return out.withColumns({f"{s}_change": rnd(F.col(f"{s}_weight") - current[s], 3) for s in SUB_SCORES})


def weights_decision(weights: DataFrame, max_change: float = 0.10, min_change: float = 0.03) -> DataFrame:
    """Apply or not, and the first guard that refused."""
    big = F.greatest(*[F.abs(f"{s}_change") for s in SUB_SCORES])
    reason = (
        F.when(F.col("status") != "ok", F.concat(F.lit("status="), "status")).when(~F.col("oos_passed"), "oos_failed")
        .when(F.col("confidence") == "low", "low_confidence").when(big > max_change, "change_too_large")
        .when(big < min_change, "no_meaningful_change"))
    return weights.select(reason.isNull().alias("applied"), reason.alias("reason"),
                          *[f"{s}_weight" for s in SUB_SCORES], "confidence", "n")


def threshold_decision(selection: DataFrame, current: float, min_change: float = 0.10) -> DataFrame:
    gap = F.abs(F.col("recommended_threshold") - current)
    reason = (F.when(F.col("status") != "ok", F.concat(F.lit("status="), "status"))
              .when(F.col("recommended_threshold").isNull(), "no_recommendation").when(gap < min_change, "too_close"))
    return selection.select(reason.isNull().alias("applied"), reason.alias("reason"), "recommended_threshold")


def weight_stability(history: DataFrame, weeks: int = 3) -> DataFrame:
    """(sub_score, run_date, weeks_loaded, n_reversals, stable): did a weight turn direction in the runs up to each run?

    ``history``: (sub_score, run_date, weight), one row per run. A run looks back at the runs exactly one to ``weeks``
    weeks before it; absent ones are skipped, so two neighbours may be two weeks apart. A step needs both weights; a
    reversal is two steps after each other with different signs, neither of them zero. Every run is sent to the dates
    that look back at it, so four rows at most meet per run and sub-score.
    """
    dates = history.select("sub_score", F.col("run_date").alias("seen_from"))
    sent = history.withColumn("seen_from", F.explode(F.array(*[F.date_add("run_date", 7 * k) for k in range(weeks + 1)])))
    runs = sent.join(dates, ["sub_score", "seen_from"], "left_semi").groupBy("sub_score", "seen_from").agg(
        F.sort_array(F.collect_list(F.struct("run_date", "weight"))).alias("w"))
    steps = F.zip_with(F.slice("w", 2, weeks + 1), F.slice("w", 1, F.size("w") - 1), lambda new, old: rnd(new["weight"] - old["weight"], 8))
    d = runs.withColumn("s", F.array_compact(steps))
    turns = F.zip_with(F.slice("s", 2, weeks), F.slice("s", 1, F.greatest(F.size("s") - 1, F.lit(0))), lambda new, old: new * old < 0)
    n = F.size(F.filter(turns, lambda x: x))
    return d.select("sub_score", F.col("seen_from").alias("run_date"), (F.size("w") - 1).alias("weeks_loaded"),
                    n.alias("n_reversals"), (n == 0).alias("stable"))


# --- parameter moves -----------------------------------------------------------------

def boost_moves(params: DataFrame, correlations: DataFrame, drivers: dict[str, str], blend: float = 0.30,
                least: int = 10, strong: float = 0.05, max_change: float = 0.50) -> DataFrame:
    """Raise a boost 15 % toward the data when it helps, lower it when it hurts."""
    spark = params.sparkSession
    link = spark.createDataFrame(list(drivers.items()), "key string, boost string")
    c = correlations.select("boost", "r_10d", "n_nonzero")
    d = params.join(F.broadcast(link), "key", "left").join(c, "boost", "left")
    usable = F.col("r_10d").isNotNull() & (F.col("n_nonzero") >= least)
    factor = F.when(usable & (F.col("r_10d") > strong), 1.15).when(usable & (F.col("r_10d") < -strong), 0.85)
    old = F.col("value")
    moved = rnd(old * (1 - blend) + old * factor * blend, 2)
    share = F.try_divide(F.abs(moved - old), F.abs(old))
    capped = F.when(share > max_change, rnd(old * (1 + F.signum(moved - old) * max_change), 4)).otherwise(moved)
    d = d.withColumn("new_value", F.coalesce(capped, old))
    return d.select("key", "value", "new_value", rnd(F.col("new_value") - old, 4).alias("change"))


def scanner_moves(params: DataFrame, relax: DataFrame, blend: float = 0.30, step: float = 0.20) -> DataFrame:
    """Loosen the threshold behind each leaking gate, within its floor or ceiling."""
    spark = params.sparkSession
    rules = spark.createDataFrame([
        ("tech_score_min", "tech_score", -1.0, 0, 40.0, None), ("max_atr_pct", "volatility_pass", 1.0, 1, None, 15.0),
        ("min_avg_volume", "liquidity_pass", -1.0, 0, 100000.0, None),
    ], "key string, gate string, sign double, digits int, floor double, ceiling double")
    leaking = relax.select("gate", F.lit(True).alias("__leaks"))
    d = params.join(F.broadcast(rules), "key", "left").join(leaking, "gate", "left")
    old = F.col("value")
    raw = old * (1 - blend) + old * (1 + F.col("sign") * step) * blend
    rounded = F.when(F.col("key") == "min_avg_volume", F.floor(raw + 1e-9).cast("double")).when(
        F.col("digits") == 1, rnd(raw, 1)).otherwise(rnd(raw, 0))
    bounded = F.least(F.greatest(rounded, F.coalesce("floor", rounded)), F.coalesce("ceiling", rounded))
    new = F.when(F.coalesce("__leaks", F.lit(False)), bounded).otherwise(old)
    # the floor may lie above the rounded value, so it is applied last
    new = F.when(F.coalesce("__leaks", F.lit(False)), F.greatest(new, F.coalesce("floor", new))).otherwise(old)
    return d.select("key", "value", new.alias("new_value"), rnd(new - old, 4).alias("change"))


def merge_parameters(existing: DataFrame, updates: DataFrame, run_date: str, reason: str) -> DataFrame:
    """Updated parameter table with the origin of each value."""
    u = updates.select("key", F.col("value").alias("__new"))
    d = existing.join(u, "key", "full")
    changed = F.col("__new").isNotNull()
    return d.select(
        "key", F.coalesce("__new", "value").alias("value"), F.when(changed, run_date).alias("updated_on"),
        F.when(changed, reason).alias("reason"))


# --- triggers, teams, committee --------------------------------------------------------

def trigger_actions(scorecard: DataFrame, min_trades: int = 50, worst_alpha: float = -0.005, worst_win: float = 0.40,
                    fallback: str = "time_expiry", worst_slippage_bps: float = 20) -> DataFrame:
    """Keep or disable each trigger, with the reasons in a fixed order; the fallback survives when all others would go.

    Slippage against the open (percent in the scorecard, where it has the column) is a reason, but disables nothing.
    """
    d = scorecard.filter(F.col("trigger") != "(all)")
    judged = F.col("n_trades") >= min_trades
    loses = F.coalesce(F.col("avg_realized_alpha") < worst_alpha, F.lit(False))
    fails = F.coalesce(F.col("win_rate_vs_spy") < worst_win, F.lit(False))
    slips = F.col("avg_slippage_vs_open") * 100 > worst_slippage_bps if "avg_slippage_vs_open" in d.columns else F.lit(False)
    d = d.withColumn("__off", judged & (loses | fails))
    every = F.count_if("__off").over(_all()) >= F.count_if(judged).over(_all())
    spared = F.col("__off") & (F.col("trigger") == fallback) & every
    found = F.array_compact(F.array(*(F.when(c, name) for c, name in (
        (loses, "negative_alpha"), (slips, "high_slippage"), (fails, "low_win_rate")))))
    return d.select(
        "trigger", "n_trades", judged.alias("evaluated"), F.when(F.col("__off") & ~spared, "disable").otherwise("keep").alias("action"),
        F.when(~judged, F.array(F.lit("insufficient_data"))).when(spared, F.array(F.lit("preserved_as_fallback")))
        .otherwise(found).alias("reasons"),
        rnd(F.when(judged, F.col("avg_realized_alpha")), 4).alias("avg_alpha"), rnd(F.when(judged, F.col("win_rate_vs_spy")), 3).alias("win_rate"))


def _enough_dates(df: DataFrame, dates: DataFrame, min_dates: int, verdicts: list[str]) -> DataFrame:
    """Add ``status``; without enough run dates (one row, ``n_dates``) the verdicts are NULL."""
    enough = F.col("n_dates") >= min_dates
    d = with_scalars(df, dates.select("n_dates")).withColumns({v: F.when(enough, F.col(v)) for v in verdicts})
    return d.withColumn("status", F.when(enough, "ok").otherwise("insufficient_data")).drop("n_dates")


def team_slots(lift: DataFrame, slots: DataFrame, dates: DataFrame, threshold: float = 0.005, least: int = 1,
               most: int = 5, min_dates: int = 8) -> DataFrame:
    """Assessment of each team by its lift over its sector, and the slots it should get."""
    x = F.col("lift")
    change = F.when(x < -threshold, -1).when(x > threshold, 1).otherwise(0)
    label = F.when(x.isNull(), "no_data").when(x < -threshold, "underperforming").when(
        x > threshold, "outperforming").otherwise("neutral")
    new = F.greatest(F.lit(least), F.least(F.col("slots") + F.col("slot_change"), F.lit(most)))
    d = lift.select("team_id", "lift", "lift_vs_quant", "n_picks", label.alias("assessment"), change.alias("slot_change"))
    d = d.join(slots, "team_id", "left").withColumn("recommended_slots", F.when(
        F.col("slots").isNotNull(), F.when(F.col("slot_change") != 0, new).otherwise(F.col("slots"))))
    return _enough_dates(d, dates, min_dates, ["assessment", "slot_change", "recommended_slots"])


def committee_mode(committee: DataFrame, ranking: DataFrame, dates: DataFrame, least_lift: float = 0.0,
                   worst_lift: float = -0.005, min_dates: int = 8) -> DataFrame:
    row = with_scalars(committee.select(F.col("lift").alias("cio_lift")),
                       ranking.select(F.col("lift").alias("cio_vs_ranking_lift")))
    weak = F.coalesce(F.col("cio_vs_ranking_lift") < least_lift, F.lit(False)) | F.coalesce(
        F.col("cio_lift") < worst_lift, F.lit(False))
    row = row.withColumn("recommendation", F.when(weak, "deterministic").otherwise("keep"))
    return _enough_dates(row, dates, min_dates, ["recommendation"])


# --- variants, cut-offs, comparisons -----------------------------------------------------

def _gain(new: Column, old: Column) -> Column:
    return F.coalesce(F.try_divide(new - old, F.when(old != 0, F.abs(old))), F.lit(0.0))


def best_variant(stats: DataFrame, baseline: str, n_years: float | str, min_gain: float = 0.10, min_years: float = 5.0) -> DataFrame:
    """``stats``: (variant, sharpe_ratio).  The best variant, if it beats the baseline by enough.

    ``n_years`` is a number or a column of ``stats`` with one value.
    """
    years = F.max(n_years) if isinstance(n_years, str) else F.max(F.lit(n_years))
    base = F.coalesce(F.max(F.when(F.col("variant") == baseline, F.col("sharpe_ratio"))), F.lit(0.0))
    other = F.when(F.col("variant") != baseline, F.struct(F.col("sharpe_ratio"), F.col("variant")))
    row = stats.agg(base.alias("baseline_sharpe"), F.min_by("variant", F.struct(-F.col("sharpe_ratio"), F.col("variant")))
                    .alias("__any"), F.max(other).alias("__o"), years.alias("__years"))
    best, name = F.col("__o.sharpe_ratio"), F.col("__o.variant")
    gain = _gain(best, F.col("baseline_sharpe"))
    better = F.coalesce(best > F.col("baseline_sharpe"), F.lit(False))
    status = (F.when(~better, "baseline_best").when(gain < min_gain, "below_threshold")
              .when(F.col("__years") < min_years, "insufficient_history").otherwise("ok"))
    return row.select(
        F.when(better, name).otherwise(baseline).alias("best_variant"), F.when(better, best).otherwise(
            F.col("baseline_sharpe")).alias("best_sharpe"), "baseline_sharpe", rnd(F.when(better, gain), 4).alias("improvement"),
        status.alias("status"), F.when(status == "ok", name).alias("recommended_variant"))


def alpha_cutoffs(predictions: DataFrame, cutoffs: list[float]) -> DataFrame:
    """Predictions and predictions per day at each alpha cut-off (0 keeps everything).

    Per date the rows are summed once under the highest cut-off they reach; the
    cumulative sums run over dates x cut-offs, never over predictions.
    """
    ordered = sorted(cutoffs)
    hits = F.array_compact(F.array(*[
        F.when((F.col("alpha") >= c) if c > 0 else F.lit(True), F.lit(c)) for c in ordered]))
    parts = predictions.groupBy("date", F.array_max(hits).alias("top")).agg(F.count("*").alias("n"))
    spread = parts.select("date", "n", F.explode(F.filter(
        F.array(*[F.lit(c) for c in ordered]), lambda c: c <= F.col("top"))).alias("cutoff"))
    days = spread.groupBy("cutoff", "date").agg(F.sum("n").alias("n"))
    return days.groupBy("cutoff").agg(F.sum("n").alias("n_predictions"), F.count("*").alias("n_dates")).withColumn(
        "predictions_per_day", rnd(ratio(F.col("n_predictions"), F.col("n_dates")), 4))


def choose_cutoff(rows: DataFrame, baseline_sharpe: float | Column, min_gain: float = 0.05) -> DataFrame:
    base = F.lit(baseline_sharpe) if not isinstance(baseline_sharpe, Column) else baseline_sharpe
    best = rows.filter(F.col("sharpe_ratio").isNotNull()).orderBy(F.col("sharpe_ratio").desc(), "cutoff").limit(1)
    gain = _gain(F.col("sharpe_ratio"), base)
    good = (F.col("sharpe_ratio") > base) & (gain >= min_gain)
    return best.select(F.col("cutoff").alias("best_cutoff"), F.col("sharpe_ratio").alias("best_sharpe"),
                       *[c for c in ("predictions_per_day",) if c in rows.columns], rnd(gain, 4).alias("improvement"), F.when(good, F.col("cutoff")).alias("recommended_cutoff"))


def compare_pair(stats: DataFrame, key: str, a, b, metrics: list[str]) -> DataFrame:
    """Both values and b - a per metric, one row per metric."""
    d = stats.filter(F.col(key).isin(a, b)).select(key, *[F.col(m).cast("double").alias(m) for m in metrics])
    long = d.unpivot(key, metrics, "metric", "value")
    at = lambda v: F.max(F.when(F.col(key) == v, F.col("value")))
    return long.groupBy("metric").agg(at(a).alias("before"), at(b).alias("after")).withColumn(
        "delta", rnd(F.col("after") - F.col("before"), 6))


def ablation(stats: DataFrame, key: str, full, pruned, tolerance: float = 0.05) -> DataFrame:
    """Prune when the Sharpe ratio does not fall by more than the tolerance."""
    at = lambda v: F.max(F.when(F.col(key) == v, F.col("sharpe_ratio")))
    row = stats.agg(at(full).alias("baseline_sharpe"), at(pruned).alias("pruned_sharpe"))
    gain = _gain(F.col("pruned_sharpe"), F.col("baseline_sharpe"))
    return row.withColumn("sharpe_change_pct", rnd(gain * 100, 2)).withColumn("recommend_pruning", gain >= -tolerance)


def sizing_comparison(stats: DataFrame, key: str, sized, equal, min_trades: int = 50, band: float = 0.1) -> DataFrame:
    """Current sizing against equal weights."""
    at = lambda v, c: F.max(F.when(F.col(key) == v, F.col(c)))
    row = stats.agg(*[at(v, c).alias(f"{c}_{n}") for n, v in (("a", sized), ("b", equal))
                      for c in ("total_trades", "sharpe_ratio", "total_return", "total_alpha")])
    diff = lambda c: F.col(f"{c}_a") - F.col(f"{c}_b")
    sharpe = F.when((F.col("sharpe_ratio_a") != 0) & (F.col("sharpe_ratio_b") != 0), diff("sharpe_ratio"))
    few = F.least("total_trades_a", "total_trades_b") < min_trades
    return row.select(
        F.when(few, "insufficient_data").otherwise("ok").alias("status"), rnd(sharpe, 3).alias("sharpe_diff"),
        rnd(diff("total_return"), 4).alias("return_diff"), rnd(diff("total_alpha"), 4).alias("alpha_diff"),
        F.when(sharpe > band, "sizing_helps").when(sharpe < -band, "equal_weight_better").otherwise("no_difference")
        .alias("assessment"))


def regression_check(current: DataFrame, baseline: DataFrame, accuracy_pp: float = 5.0, sharpe_pct: float = 0.20) -> DataFrame:
    """Current metrics against the newest promotion baseline; no baseline, no check."""
    b = baseline.select(F.col("accuracy_10d").alias("base_accuracy"), F.col("sharpe_ratio").alias("base_sharpe"),
                        F.lit(True).alias("__b"))
    d = with_scalars(current.select("accuracy_10d", "sharpe_ratio"), b)
    acc = (F.col("base_accuracy") - F.col("accuracy_10d")) * 100
    drop = F.when(F.col("base_sharpe") > 0, ratio(F.col("base_sharpe") - F.col("sharpe_ratio"), F.abs("base_sharpe")))
    bad = F.coalesce(acc > accuracy_pp, F.lit(False)) | F.coalesce(drop > sharpe_pct, F.lit(False))
    return d.select(F.coalesce("__b", F.lit(False)).alias("checked"), rnd(acc, 4).alias("accuracy_drop"),
                    rnd(drop, 4).alias("sharpe_drop_pct"), bad.alias("regression_detected"))


# --- alerts and decisions ------------------------------------------------------------------

def retrain_triggers(health: DataFrame, drift: DataFrame, calibration: DataFrame, regimes: DataFrame, asof,
                     deployed_on=None, grace_days: int = 30, drift_limit: float = 0.20, ece_limit: float = 0.10) -> DataFrame:
    """(trigger, severity, value): at most one row per rule.  A calibration breakdown
    is not reported in the first days of a new calibrator."""
    def fired(df, name, severity, cond, value):
        return df.filter(cond).select(F.lit(name).alias("trigger"), F.lit(severity).alias("severity"),
                                      value.cast("double").alias("value"))

    age = F.datediff(F.lit(asof).cast("date"), F.lit(deployed_on).cast("date"))
    in_grace = F.coalesce((age >= 0) & (age < grace_days), F.lit(False))
    order = F.when(F.col("regime") == "bull", 0).when(F.col("regime") == "neutral", 1).when(F.col("regime") == "bear", 2).otherwise(3)
    first_bad = regimes.filter(F.col("ic") < 0).agg(F.min_by("ic", order).alias("ic")).filter(F.col("ic").isNotNull())
    dominant = F.greatest("share_up", "share_flat", "share_down")
    parts = [
        fired(health, "ic_degradation", "high", F.col("degradation_flag"), F.col("ic_ratio")),
        fired(drift, "feature_drift", "high", F.col("drift_fraction") > drift_limit, F.col("drift_fraction")),
        fired(calibration, "calibration_breakdown", "medium", (F.col("overall_ece") > ece_limit) & ~in_grace, F.col("overall_ece")),
        fired(first_bad, "regime_negative_ic", "medium", F.lit(True), F.col("ic")),
        fired(health, "mode_collapse", "high", F.col("mode_collapse_flag"), dominant),
    ]
    return reduce(DataFrame.unionByName, parts)


def alert_status(triggers: DataFrame, history: DataFrame, asof, quiet_days: int = 2) -> DataFrame:
    """Whether to alert now: something fired and the last alert is old enough.  One row."""
    row = triggers.agg(F.count("*").alias("n_triggers"), F.count_if(F.col("severity") == "high").alias("n_high"))
    last = history.agg(F.max("date").alias("last_alert"))
    age = F.datediff(F.lit(asof).cast("date"), F.col("last_alert"))
    quiet = F.coalesce(age < quiet_days, F.lit(False))
    return with_scalars(row, last).select(
        "n_triggers", "n_high", "last_alert", (F.col("n_triggers") > 0).alias("triggered"),
        F.when(F.col("n_triggers") == 0, "no_triggers").when(quiet, "suppressed").otherwise("send").alias("decision"))


def decision_label(results: DataFrame) -> DataFrame:
    """``results``: (optimizer, status, applied, reason).  One word per optimizer."""
    label = (
        F.when(F.col("status").isNull(), "NOT RUN").when(F.col("applied"), "PROMOTED")
        .when(F.contains("reason", F.lit("frozen")), "FROZEN").when(F.col("reason").isNotNull(), "REJECTED")
        .when(F.col("status") == "ok", "EVALUATED").when(F.col("status") == "error", "ERROR")
        .when(F.col("status") == "skipped", "SKIPPED").otherwise("DEFERRED"))
    return results.withColumn("decision", label)


def promoted(results: DataFrame) -> DataFrame:
    return results.filter(F.coalesce("applied", F.lit(False))).select("optimizer")


