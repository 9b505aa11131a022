"""Executed and blocked trades: exit timing, triggers, post-trade and veto value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.aggregates import binary_metrics, null_safe_mean, win_rate
from assay.functions.frames import with_scalars
from assay.functions.ranks import exact_quantiles
from assay.functions.scalars import (
    ENTRY_TRIGGERS, EXIT_RULES, POST_TRADE_TRIGGERS, bucket_right_closed, keyword_category, ratio, rnd,
    time_of_day,
)
from assay.operators.asof import interval_extremes

HOLDING_BUCKETS = [("1-2d", 0, 2), ("3-5d", 2, 5), ("6-10d", 5, 10), ("11-20d", 10, 20), ("21+d", 20, 999)]
CONFIDENCE_BINS = [("50-55%", -1e-12, 0.55), ("55-65%", 0.55, 0.65), ("65-75%", 0.65, 0.75), ("75%+", 0.75, 1.0)]
DEFAULT_POSITION = 50_000.0


def entries(trades: DataFrame) -> DataFrame:
    return trades.filter(F.col("action") == "ENTER")


def round_trips(trades: DataFrame) -> DataFrame:
    """Every EXIT / REDUCE joined to the ENTER it closes, by id."""
    exits = trades.filter(
        F.col("action").isin("EXIT", "REDUCE") & F.col("fill_price").isNotNull()
    ).select(
        F.col("trade_id").alias("exit_id"), "entry_trade_id", "ticker", F.col("date").alias("exit_date"),
        F.col("fill_price").alias("exit_price"), F.col("trigger_type").alias("exit_type"),
        "realized_return_pct", "realized_alpha_pct", "days_held",
    )
    opened = entries(trades).filter(F.col("fill_price").isNotNull()).select(
        F.col("trade_id").alias("entry_trade_id"), F.col("date").alias("entry_date"),
        F.col("fill_price").alias("entry_price"), "signal_price",
    )
    return exits.join(opened, "entry_trade_id")


def exit_timing(trades: DataFrame, bars: DataFrame) -> DataFrame:
    """Best and worst excursion of each round trip and how much of the best was kept."""
    trips = round_trips(trades).filter(F.col("entry_price") > 0)
    reach = interval_extremes(trips, bars, "exit_id", "entry_date", "exit_date")
    pct = lambda p: (F.col(p) - F.col("entry_price")) / F.col("entry_price") * 100
    mfe, mae = pct("max_high"), pct("min_low")
    fallback = F.when(F.col("exit_price") != 0, pct("exit_price"))
    realized = F.coalesce("realized_return_pct", fallback)
    return trips.join(reach, "exit_id").filter(realized.isNotNull()).select(
        "exit_id", "ticker", "entry_date", "exit_date", "exit_type", "entry_price", "exit_price",
        rnd(mfe, 2).alias("mfe_pct"), rnd(mae, 2).alias("mae_pct"),
        rnd(realized, 2).alias("realized_return_pct"),
        rnd(F.when(mfe > 0.01, realized / mfe), 2).alias("capture_ratio"), "days_held",
    )


def exit_timing_summary(timed: DataFrame, min_roundtrips: int = 5) -> DataFrame:
    row = timed.agg(
        F.count("*").alias("n_roundtrips"), rnd(F.avg("mfe_pct"), 2).alias("avg_mfe"),
        rnd(F.avg("mae_pct"), 2).alias("avg_mae"),
        rnd(F.avg("realized_return_pct"), 2).alias("avg_realized_return"),
        rnd(F.avg("capture_ratio"), 2).alias("avg_capture_ratio"),
    )
    long = timed.select(F.explode(F.array(
        F.struct(F.lit("median_mfe").alias("m"), F.col("mfe_pct").alias("v")),
        F.struct(F.lit("median_mae").alias("m"), F.col("mae_pct").alias("v")))).alias("x")).select("x.*")
    medians = exact_quantiles(long, ["m"], "v", [0.5])
    row = with_scalars(row, medians.agg(*[
        rnd(F.max(F.when(F.col("m") == m, F.col("quantile"))), 2).alias(m) for m in ("median_mfe", "median_mae")]))
    capture = F.col("avg_capture_ratio")
    diagnosis = (
        F.when(capture < 0.3, "exits_too_early")
        .when(F.col("avg_realized_return") > F.col("avg_mfe") * 0.6, "exits_well_timed")
        .when(capture > 0.8, "exits_well_timed")
        .otherwise("exits_could_improve")
    )
    return row.withColumn("diagnosis", diagnosis).filter(F.col("n_roundtrips") >= min_roundtrips)


def exit_timing_by_type(timed: DataFrame, min_trades: int = 2) -> DataFrame:
    return timed.filter(F.col("exit_type").isNotNull()).groupBy("exit_type").agg(
        F.count("*").alias("n"), rnd(F.avg("mfe_pct"), 2).alias("avg_mfe"),
        rnd(F.avg("mae_pct"), 2).alias("avg_mae"),
        rnd(F.avg("realized_return_pct"), 2).alias("avg_realized"),
        rnd(F.avg("capture_ratio"), 2).alias("avg_capture"),
    ).filter(F.col("n") >= min_trades)


def trigger_scorecard(trades: DataFrame, min_trades: int = 3) -> DataFrame:
    """Per entry trigger and, in the row ``(all)``, over all of them: one roll-up."""
    def slip(against):
        p = F.col(against)
        return F.when(p > 0, (F.col("fill_price") - p) / p * 100)

    alpha = F.col("realized_alpha_pct")
    rows = (
        entries(trades)
        .withColumn("trigger", keyword_category("trigger_type", ENTRY_TRIGGERS))
        .rollup("trigger")
        .agg(
            F.grouping("trigger").alias("__all"), F.count("*").alias("n_trades"),
            null_safe_mean(slip("signal_price")).alias("avg_slippage_vs_signal"),
            null_safe_mean(slip("price_at_order")).alias("avg_slippage_vs_open"),
            null_safe_mean(alpha).alias("avg_realized_alpha"),
            null_safe_mean("realized_return_pct").alias("avg_realized_return"),
            null_safe_mean("days_held").alias("avg_days_held"),
            win_rate(alpha).alias("win_rate_vs_spy"),
            F.count_if(alpha > 0).alias("tp"), F.count_if(alpha <= 0).alias("fp"),
        )
    )
    total = F.col("__all") == 1
    return (
        rows.filter(total | (F.col("n_trades") >= min_trades))
        .withColumn("trigger", F.when(total, "(all)").otherwise(F.col("trigger")))
        .withColumn("precision", rnd(ratio(F.col("tp"), F.col("tp") + F.col("fp")), 4))
        .drop("__all")
    )


def trigger_scorecard_status(trades: DataFrame, min_trades: int = 3) -> DataFrame:
    """The scorecard with a row for every trigger: below the gate its status says so and its figures are NULL."""
    card = trigger_scorecard(trades, 0)
    enough = (F.col("trigger") == "(all)") | (F.col("n_trades") >= min_trades)
    return card.select(
        "trigger", F.when(enough, "ok").otherwise("insufficient_data").alias("status"), "n_trades",
        *[F.when(enough, F.col(c)).alias(c) for c in card.columns if c not in ("trigger", "n_trades")])


def post_trade_by_trigger(trades: DataFrame, min_trades: int = 3) -> DataFrame:
    return (
        entries(trades)
        .groupBy(keyword_category("trigger_type", POST_TRADE_TRIGGERS).alias("trigger"))
        .agg(
            F.count("*").alias("n_trades"), null_safe_mean("realized_alpha_pct").alias("avg_alpha_pct"),
            null_safe_mean("slippage_vs_signal").alias("avg_slippage_pct"),
            null_safe_mean("days_held").alias("avg_days_held"),
            win_rate("realized_alpha_pct").alias("win_rate_vs_spy"),
        )
        .filter(F.col("n_trades") >= min_trades)
    )


def post_trade_by_exit(trades: DataFrame, min_trades: int = 3) -> DataFrame:
    closed = trades.filter(F.col("action").isin("EXIT", "REDUCE") & F.col("entry_trade_id").isNotNull())
    return (
        closed.groupBy(keyword_category("exit_reason", EXIT_RULES).alias("exit_rule"))
        .agg(
            F.count("*").alias("n_trades"), null_safe_mean("realized_alpha_pct").alias("avg_alpha_pct"),
            null_safe_mean("realized_return_pct").alias("avg_return_pct"),
            null_safe_mean("days_held").alias("avg_days_held"),
            win_rate("realized_alpha_pct").alias("win_rate_vs_spy"),
        )
        .filter(F.col("n_trades") >= min_trades)
    )


def post_trade_by_holding(trades: DataFrame) -> DataFrame:
    """Right-closed day ranges; a same-day round trip belongs to none of them."""
    return (
        entries(trades)
        .filter(F.col("realized_alpha_pct").isNotNull() & F.col("days_held").isNotNull())
        .withColumn("bucket", bucket_right_closed("days_held", HOLDING_BUCKETS))
        .filter(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(
            F.count("*").alias("n_trades"), null_safe_mean("realized_alpha_pct").alias("avg_alpha_pct"),
            null_safe_mean("realized_return_pct").alias("avg_return_pct"),
            win_rate("realized_alpha_pct").alias("win_rate_vs_spy"),
        )
    )


def slippage_by_time_of_day(trades: DataFrame) -> DataFrame:
    return (
        entries(trades)
        .filter(F.col("fill_time").isNotNull())
        .withColumn("time_bucket", time_of_day("fill_time"))
        .filter(F.col("time_bucket") != "unknown")
        .groupBy("time_bucket")
        .agg(
            F.count("*").alias("n_trades"), null_safe_mean("slippage_vs_signal").alias("avg_slippage_pct"),
            null_safe_mean("realized_alpha_pct").alias("avg_alpha_pct"),
        )
    )


def best_by(rows: DataFrame, name: str, metric: str, out: str) -> DataFrame:
    """Name of the row with the highest metric, the first name on a tie."""
    return rows.filter(F.col(metric).isNotNull()).agg(
        F.min_by(name, F.struct(-F.col(metric), F.col(name))).alias(out))


def post_trade_summary(trades: DataFrame, min_trades: int = 3) -> DataFrame:
    is_entry = F.col("action") == "ENTER"
    is_exit = F.col("action").isin("EXIT", "REDUCE") & F.col("entry_trade_id").isNotNull()
    only = lambda c: F.when(is_entry, F.col(c))
    row = trades.agg(
        F.count_if(is_entry).alias("n_entries"), F.count_if(is_exit).alias("n_exits"),
        F.count(only("realized_alpha_pct")).alias("n_roundtrips"),
        null_safe_mean(only("realized_alpha_pct")).alias("avg_alpha_pct"),
        null_safe_mean(only("slippage_vs_signal")).alias("avg_slippage_pct"),
        null_safe_mean(only("days_held")).alias("avg_days_held"),
        win_rate(only("realized_alpha_pct")).alias("win_rate_vs_spy"),
    )
    best_trigger = best_by(post_trade_by_trigger(trades, min_trades), "trigger", "avg_alpha_pct", "best_trigger")
    best_exit = best_by(post_trade_by_exit(trades, min_trades), "exit_rule", "avg_alpha_pct", "best_exit_rule")
    return with_scalars(row, best_trigger, best_exit)


def blocked_vs_traded(blocked: DataFrame, trades: DataFrame, universe: DataFrame, min_blocks: int = 3) -> DataFrame:
    """Forward returns of what the risk guard stopped against what it let through.

    Positive class: the stock lost to the benchmark; selected: it was blocked.
    """
    fwd = universe.filter(F.col("return_5d").isNotNull()).select(
        "ticker", F.col("eval_date").alias("date"), "return_5d", "beat_spy_5d")
    keys = ["ticker", "date"]
    opened = entries(trades).select(*keys, "realized_alpha_pct")
    both = (
        blocked.select(*keys, F.lit(None).cast("double").alias("realized_alpha_pct"), F.lit(True).alias("b"))
        .unionByName(opened.withColumn("b", F.lit(False)))
        .join(fwd, keys, "left")
    )
    b, has = F.col("b"), F.col("return_5d").isNotNull()
    beat = F.col("beat_spy_5d")
    row = both.agg(
        F.count_if(b).alias("n_blocked"), F.count_if(~b).alias("n_traded"),
        rnd(F.avg(F.when(b, F.col("return_5d"))), 4).alias("blocked_avg_return_5d"),
        rnd(F.avg(F.when(b, beat)), 4).alias("blocked_beat_spy_pct"),
        F.count_if(b & has).alias("blocked_with_returns"),
        rnd(F.avg(F.when(~b, F.col("return_5d"))), 4).alias("traded_avg_return_5d"),
        rnd(F.avg(F.when(~b, beat)), 4).alias("traded_beat_spy_pct"),
        F.count_if(~b & has).alias("traded_with_returns"),
        rnd(F.avg(F.when(~b, F.col("realized_alpha_pct"))), 4).alias("traded_avg_alpha"),
        F.count_if(b & (beat == 0)).alias("tp"), F.count_if(b & (beat == 1)).alias("fp"),
        F.count_if(~b & (beat == 0)).alias("fn"), F.count_if(~b & (beat == 1)).alias("tn"),
    )
    traded = F.coalesce("traded_avg_return_5d", "traded_avg_alpha")
    guard = rnd(traded - F.col("blocked_avg_return_5d"), 4)
    return (
        binary_metrics(row).withColumn("guard_lift", guard)
        .withColumn("assessment", F.when(F.col("guard_lift").isNull(), "insufficient_return_data")
                    .when(F.col("guard_lift") > 0.5, "appropriate")
                    .when(F.col("guard_lift") < -0.5, "too_tight").otherwise("neutral"))
        .filter(F.col("n_blocked") >= min_blocks)
    )


def block_reasons(blocked: DataFrame, universe: DataFrame) -> DataFrame:
    fwd = universe.filter(F.col("return_5d").isNotNull()).select(
        "ticker", F.col("eval_date").alias("date"), "return_5d")
    rows = blocked.join(fwd, ["ticker", "date"], "left").groupBy("block_reason").agg(
        F.count("*").alias("count"), rnd(F.avg("research_score"), 2).alias("avg_score"),
        rnd(F.avg("return_5d"), 4).alias("avg_return_5d"), F.count("return_5d").alias("n_with_returns"))
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))  # one row per reason
    return rows.withColumn("pct_of_blocks", rnd(ratio(F.col("count"), total), 4))


def sized_vetoes(predictions: DataFrame, blocked: DataFrame, default_size: float = DEFAULT_POSITION,
                 latest_by: str | None = None) -> DataFrame:
    """Resolved DOWN predictions with the position they would have had, in dollars."""
    size = (
        blocked.filter(F.contains("block_reason", F.lit("veto")) | (F.col("predicted_direction") == "DOWN"))
        .filter(F.col("intended_dollars") != 0)
        .groupBy(F.col("ticker").alias("symbol"), F.col("date").alias("prediction_date"))
        .agg((F.max_by("intended_dollars", latest_by) if latest_by else F.max("intended_dollars")).alias("size"))
    )
    down = predictions.filter(
        (F.col("predicted_direction") == "DOWN") & F.col("actual_5d_return").isNotNull())
    return down.join(size, ["symbol", "prediction_date"], "left").withColumn(
        "position_dollars", F.coalesce("size", F.lit(default_size)))


def _veto_sums(unit: float):
    lost = F.col("actual_5d_return") < 0
    impact = F.col("position_dollars") * F.col("actual_5d_return") / unit
    return [
        F.count("*").alias("n_vetoes"), F.count_if(lost).alias("n_correct"), F.count_if(~lost).alias("n_incorrect"),
        F.coalesce(F.sum(F.when(lost, F.abs(impact))), F.lit(0.0)).alias("__avoided"),
        F.coalesce(F.sum(F.when(~lost, impact)), F.lit(0.0)).alias("__forgone"),
        F.avg("actual_5d_return").alias("__mean"),
    ]


def _net() -> F.Column:
    """Saved less forgone; the sums lose the noise of their order before the difference is rounded."""
    return rnd(rnd("__avoided", 4) - rnd("__forgone", 4), 2)


def veto_value(predictions: DataFrame, blocked: DataFrame, unit: float = 100.0,
               default_size: float = DEFAULT_POSITION, min_rows: int = 3) -> DataFrame:
    """Dollars saved and forgone by vetoes; ``unit`` 100 for percent points, 1 for fractions."""
    row = sized_vetoes(predictions, blocked, default_size).agg(*_veto_sums(unit))
    per = lambda s, n: rnd(F.coalesce(ratio(F.col(s), F.col(n)), F.lit(0.0)), 2)
    return row.select(
        "n_vetoes", "n_correct", "n_incorrect",
        rnd(ratio(F.col("n_correct"), F.col("n_vetoes")), 4).alias("precision"),
        rnd("__avoided", 2).alias("total_losses_avoided"), rnd("__forgone", 2).alias("total_alpha_foregone"),
        _net().alias("net_veto_value"),
        per("__avoided", "n_correct").alias("avg_loss_avoided"),
        per("__forgone", "n_incorrect").alias("avg_alpha_foregone"),
        rnd("__mean", 4).alias("avg_veto_alpha_pct"),
    ).filter(F.col("n_vetoes") >= min_rows)


def veto_value_by_confidence(predictions: DataFrame, blocked: DataFrame, unit: float = 100.0,
                             default_size: float = DEFAULT_POSITION) -> DataFrame:
    conf = F.coalesce("prediction_confidence", F.lit(0.5))
    rows = (
        sized_vetoes(predictions, blocked, default_size)
        .withColumn("confidence_range", bucket_right_closed(conf, CONFIDENCE_BINS))
        .filter(F.col("confidence_range").isNotNull())
        .groupBy("confidence_range").agg(*_veto_sums(unit))
    )
    return rows.select(
        "confidence_range", "n_vetoes", rnd(ratio(F.col("n_correct"), F.col("n_vetoes")), 4).alias("precision"),
        rnd("__avoided", 2).alias("losses_avoided"), rnd("__forgone", 2).alias("alpha_foregone"),
        _net().alias("net_value"))
