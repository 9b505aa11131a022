"""Comparison of live and replayed trades: counts, names, fields, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions.frames import with_scalars
from assay.functions.scalars import ratio, rnd

# Fixed values: (relative, absolute) tolerance per numeric field; fields only the
# live side can know are not compared.
TOLERANCES: dict[str, tuple[float, float]] = {
    "fill_price": (0.001, 0.01), "price_at_order": (0.001, 0.0), "trigger_price": (0.002, 0.0),
    "signal_price": (0.001, 0.0), "research_score": (0.0, 0.5), "prediction_confidence": (0.0, 0.02),
    "position_pct": (0.0, 0.005),
}
EXACT = ["ticker", "action", "trigger_type", "predicted_direction"]
NOT_COMPARED = {
    "days_held", "realized_return_pct", "realized_pnl", "realized_alpha_pct", "spy_return_during_hold", "fill_time",
    "created_at", "ib_order_id", "slippage_vs_signal", "execution_latency_ms", "date", "trigger_type", "trigger_price",
    "signal_price", "fill_price", "prediction_confidence",
}
MATCH = ["signal_trading_day", "ticker", "action"]


def within_tolerance(live: Column, replay: Column, rel: float, abs_: float) -> Column:
    """Both NULL agree, one NULL does not; either tolerance suffices."""
    gap = F.abs(live - replay)
    near = F.lit(False)
    if abs_ > 0:
        near = near | (gap <= abs_)
    if rel > 0:
        near = near | ((F.abs(live) > 1e-9) & (gap / F.abs(live) <= rel))
    if rel == 0 and abs_ == 0:
        near = F.lit(True)
    return F.when(live.isNull() & replay.isNull(), True).when(live.isNull() | replay.isNull(), False).otherwise(near)


def _per_day(df: DataFrame, day: str, out: str) -> DataFrame:
    return df.groupBy(F.col(day).alias("date")).agg(F.count("*").alias(out))


def count_divergence(live: DataFrame, replay: DataFrame, day: str = "signal_trading_day", limit: float = 0.05) -> DataFrame:
    """Days whose trade counts differ by more than ``limit`` of the live count."""
    d = _per_day(live, day, "live").join(_per_day(replay, day, "replay"), "date", "full").select(
        "date", F.coalesce("live", F.lit(0)).alias("live"), F.coalesce("replay", F.lit(0)).alias("replay"))
    share = ratio(F.abs(F.col("replay") - F.col("live")), F.greatest(F.col("live"), F.lit(1)))
    return d.withColumn("diff", F.col("replay") - F.col("live")).withColumn("pct", rnd(share, 4)).filter(share > limit)


def ticker_differences(live: DataFrame, replay: DataFrame, day: str = "signal_trading_day", allowed: int = 1) -> DataFrame:
    """(date, ticker, side) on days where more than ``allowed`` names differ."""
    keys = lambda df: df.select(F.col(day).alias("date"), "ticker").distinct()
    a, b = keys(live), keys(replay)
    only = a.join(b, ["date", "ticker"], "left_anti").withColumn("side", F.lit("only_live")).unionByName(
        b.join(a, ["date", "ticker"], "left_anti").withColumn("side", F.lit("only_replay")))
    many = only.groupBy("date").agg(F.count("*").alias("n")).filter(F.col("n") > allowed)
    return only.join(many.select("date"), "date", "left_semi")


def matched(live: DataFrame, replay: DataFrame) -> DataFrame:
    other = replay.select(*MATCH, *[F.col(c).alias(f"replay_{c}") for c in replay.columns if c not in MATCH])
    return live.join(other, MATCH)


def field_differences(live: DataFrame, replay: DataFrame) -> DataFrame:
    """One row per field of a matched trade that disagrees beyond its tolerance."""
    pair = lambda f: (F.col(f), F.col(f if f in MATCH else f"replay_{f}"))
    checks = []
    for f in EXACT:
        if f not in NOT_COMPARED:
            a, b = pair(f)
            checks.append((f, ~a.eqNullSafe(b), a, b))
    a, b = pair("shares")
    checks.append(("shares", F.coalesce(F.abs(a - b) > 1, F.lit(False)), a, b))
    for f, (rel, abs_) in TOLERANCES.items():
        if f not in NOT_COMPARED:
            a, b = pair(f)
            checks.append((f, ~within_tolerance(a, b, rel, abs_), a, b))
    found = F.array_compact(F.array(*[
        F.when(bad, F.struct(F.lit(f).alias("field"), x.cast("string").alias("live"), y.cast("string").alias("replay")))
        for f, bad, x, y in checks]))
    return matched(live, replay).select(*MATCH, F.explode(found).alias("v")).select(*MATCH, "v.*")


def parity_metrics(live: DataFrame, replay: DataFrame, day: str = "signal_trading_day") -> DataFrame:
    """Capture rate, mean overlap of the daily names, RMS count gap, field difference rate.  One row."""
    keys = lambda df, n: df.groupBy(F.col(day).alias("date"), "ticker").agg(F.count("*").alias(n))
    names = keys(live, "l").join(keys(replay, "r"), ["date", "ticker"], "full")
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    days = names.groupBy("date").agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("l"), F.coalesce(F.sum("r"), F.lit(0)).alias("r"),
        ratio(F.count_if(both), F.count("*")).alias("jaccard"))
    row = days.agg(
        F.sum("l").alias("n_live"), F.sum("r").alias("n_replay"), F.avg("jaccard").alias("j"),
        F.sqrt(F.avg(F.pow(F.col("r") - F.col("l"), 2))).alias("rms"), F.count("*").alias("n_dates"))
    m = matched(live, replay).agg(F.count("*").alias("n_matched"))
    v = field_differences(live, replay).agg(F.count("*").alias("n_field_violations"))
    zero = lambda c: rnd(F.coalesce(c, F.lit(0.0)), 4)
    return with_scalars(row, m, v).select(
        zero(ratio(F.col("n_replay"), F.col("n_live"))).alias("capture_rate"), zero(F.col("j")).alias("ticker_jaccard_avg"),
        zero(F.col("rms")).alias("count_divergence_rms"),
        zero(ratio(F.col("n_field_violations"), F.col("n_matched"))).alias("field_diff_rate"),
        "n_live", "n_replay", "n_matched", "n_field_violations", "n_dates")
