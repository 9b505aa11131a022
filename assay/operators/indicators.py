"""Technical indicators and the synthetic signals made from them.

Bars are unique per (ticker, date), so a window over one ticker never holds
more rows than there are trading days.  Everything shares one shuffle by
ticker; the recursive averages are window sums per block of bars, chained.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.scalars import clamp, conviction_of, rnd, technical_score

MIN_BARS = 210


def moving_average_distance(close: str, n: int, w) -> F.Column:
    """Percent distance from the n-bar mean; NULL until n bars exist."""
    frame = w.rowsBetween(-(n - 1), 0)
    mean = F.when(F.count(close).over(frame) == n, F.avg(close).over(frame))
    return F.try_divide(F.col(close) - mean, mean) * 100


def momentum(close: str, n: int, w) -> F.Column:
    return (F.try_divide(F.col(close), F.lag(close, n).over(w)) - 1) * 100


def lookback_return(bars: DataFrame, n: int = 20, out: str = "lookback_return") -> DataFrame:
    """Return over n rows; NULL when the earlier close is not positive."""
    w = Window.partitionBy("ticker").orderBy("date")
    prior = F.lag("close", n).over(w)
    return bars.withColumn(out, F.when(prior > 0, F.col("close") / prior - 1))


#: Bars of a ticker whose partial averages are summed in one frame, before the blocks are chained.
BLOCK_BARS = 64


def _chain(whole: F.Column):
    """Carry over one more block: what was carried shrinks by a whole block, and its end is added."""
    return lambda so_far, end: so_far * whole + end


def smoothed(df: DataFrame, means: dict[str, tuple[F.Column, float, int]]) -> DataFrame:
    """Add exponential means; ``means`` maps a name to (value, weight, first bar).

    A mean starts as the value of its first bar, and every later bar takes it
    the given weight of the way to its own value.  That is linear: inside a
    block of bars the weighted sum is a window sum of rescaled values, and the
    ends of the blocks before it, folded in order, give the carry.  Frames are
    per ticker, so the table needs one shuffle and no group leaves the JVM.
    """
    d = df.withColumns({"__i": F.col("bar_no") - 1, "__b": F.floor((F.col("bar_no") - 1) / BLOCK_BARS)})
    inside = Window.partitionBy("ticker", "__b").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("__i") % BLOCK_BARS
    sums, carried, out = {}, {}, {}
    for name, (value, weight, first) in means.items():
        keep = 1 - weight
        own = F.when(F.col("__i") < first, 0.0).when(F.col("__i") == first, value).otherwise(value * weight)
        sums[f"__s_{name}"] = F.sum(own * F.pow(F.lit(keep), -place)).over(inside) * F.pow(F.lit(keep), place)
        ends = F.collect_list(F.when(place == BLOCK_BARS - 1, F.col(f"__s_{name}"))).over(before)
        whole = F.lit(keep**BLOCK_BARS)
        carried[f"__c_{name}"] = F.aggregate(ends, F.lit(0.0), _chain(whole))
        out[name] = F.when(
            F.col("__i") >= first, F.col(f"__c_{name}") * F.pow(F.lit(keep), place + 1) + F.col(f"__s_{name}"))
    return d.withColumns(sums).withColumns(carried).withColumns(out).drop("__i", "__b", *sums, *carried)


def indicator_series(bars: DataFrame) -> DataFrame:
    """RSI(14), MACD cross and sign, distance from MA50 / MA200, 20-bar momentum, bar number.

    A bar without a close is not a bar: it is left out before bars are numbered.
    """
    w = Window.partitionBy("ticker").orderBy("date")
    move = F.coalesce(F.col("close") - F.lag("close").over(w), F.lit(0.0))
    base = bars.select("ticker", "date", F.col("close").cast("double").alias("close")).filter("close IS NOT NULL").select(
        "ticker", "date", "close", F.row_number().over(w).alias("bar_no"),
        moving_average_distance("close", 50, w).alias("price_vs_ma50"),
        moving_average_distance("close", 200, w).alias("price_vs_ma200"),
        momentum("close", 20, w).alias("momentum_20d"), move.alias("__move"),
    )
    d = smoothed(base, {
        "__up": (F.greatest("__move", F.lit(0.0)), 1 / 14, 1), "__down": (F.greatest(-F.col("__move"), F.lit(0.0)), 1 / 14, 1),
        "__fast": (F.col("close"), 2 / 13, 0), "__slow": (F.col("close"), 2 / 27, 0),
    }).withColumn("__macd", F.col("__fast") - F.col("__slow"))
    d = smoothed(d, {"__signal": (F.col("__macd"), 2 / 10, 0)}).withColumn("__gap", F.col("__macd") - F.col("__signal"))
    above = F.col("__gap") >= 0
    was_above = F.lag(above).over(w)
    d = d.withColumn("__cross", F.when(above & ~was_above, 1.0).when(~above & was_above, -1.0))
    held = F.last("__cross", ignorenulls=True).over(w.rowsBetween(-2, 0))  # a cross shows for three bars
    strength = F.try_divide(F.col("__up"), F.col("__down"))
    return d.select(
        "ticker", "date", "close", "bar_no", (100 - 100 / (1 + strength)).alias("rsi_14"),
        F.coalesce(held, F.lit(0.0)).alias("macd_cross"), (F.col("__macd") > 0).alias("macd_above_zero"),
        "price_vs_ma50", "price_vs_ma200", "momentum_20d")


def usable_indicators(series: DataFrame, min_bars: int = MIN_BARS) -> DataFrame:
    return series.filter((F.col("bar_no") >= min_bars) & F.col("rsi_14").isNotNull())


def with_momentum_percentile(df: DataFrame) -> DataFrame:
    """Ordinal rank of the momentum within its date, 0 to 100; no momentum counts as 50.

    (date, ticker) is unique, so a date holds at most one row per ticker.
    """
    known = F.col("momentum_20d").isNotNull()
    w = Window.partitionBy("date")
    rank = F.row_number().over(w.orderBy(F.col("momentum_20d").asc_nulls_last(), "ticker")) - 1
    n = F.count("momentum_20d").over(w)
    pct = F.when(known, rnd(rank / F.greatest(n - 1, F.lit(1)) * 100, 1)).otherwise(50.0)
    return df.withColumn("momentum_percentile", pct)


def score_predictions(predictions: DataFrame, series: DataFrame, sectors: DataFrame, regimes: DataFrame | None = None,
                      min_score: float = 60.0, max_adjustment: float = 10.0,
                      min_bars: int = MIN_BARS) -> DataFrame:
    """Technical score plus the bounded contribution of the predicted alpha."""
    usable = usable_indicators(series, min_bars)
    d = with_momentum_percentile(usable.join(predictions.select("ticker", "date", "alpha"), ["ticker", "date"]))
    d = d.withColumn("market_regime", F.lit("neutral")) if regimes is None else d.join(
        regimes.select("date", "market_regime"), "date", "left").withColumn(
        "market_regime", F.coalesce("market_regime", F.lit("neutral")))
    tech = technical_score("rsi_14", "macd_cross", "macd_above_zero", "price_vs_ma50", "price_vs_ma200",
                           "momentum_20d", "momentum_percentile", "market_regime")
    scored = d.withColumn("technical_score", tech).withColumn("score", rnd(clamp(
        F.col("technical_score") + clamp(F.col("alpha") * 500.0, -max_adjustment, max_adjustment), 0, 100), 2))
    signal = F.when(F.col("score") >= min_score, "ENTER").when(F.col("score") < 30, "EXIT").otherwise("HOLD")
    return scored.join(sectors.select("ticker", "sector"), "ticker", "left").select(
        "date", "ticker", "market_regime", "technical_score", "score", signal.alias("signal"),
        conviction_of("alpha").alias("conviction"), F.coalesce("sector", F.lit("Technology")).alias("sector"))


def cap_entries(scored: DataFrame, top_n: int = 20) -> DataFrame:
    """Keep the best ``top_n`` entries of a date; the others turn into HOLD.

    The kept keys come from a row_number filter, which Spark limits map-side
    before the shuffle, so a crowded date stays cheap.
    """
    order = Window.partitionBy("date").orderBy(F.col("score").desc(), "ticker")
    kept = (
        scored.filter(F.col("signal") == "ENTER").select("date", "ticker", "score")
        .withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= top_n)
        .select("date", "ticker", F.lit(True).alias("__keep"))
    )
    d = scored.join(kept, ["date", "ticker"], "left")
    demoted = (F.col("signal") == "ENTER") & F.col("__keep").isNull()
    signal = F.when(demoted, "HOLD").otherwise(F.col("signal"))
    return d.withColumn("signal", signal).drop("__keep").withColumn(
        "rating", F.when(F.col("signal") == "ENTER", "BUY").when(F.col("signal") == "EXIT", "SELL").otherwise("HOLD")
    ).withColumn("bucket", F.when(F.col("signal") == "ENTER", "buy").otherwise("universe"))


def synthetic_signals(predictions: DataFrame, bars: DataFrame, sectors: DataFrame, regimes: DataFrame | None = None,
                      top_n: int = 20, min_score: float = 60.0, min_bars: int = MIN_BARS) -> DataFrame:
    """Signals of every date at once, from bars and predicted alphas."""
    scored = score_predictions(predictions, indicator_series(bars), sectors, regimes, min_score, min_bars=min_bars)
    return cap_entries(scored, top_n)


# --- model scoring -----------------------------------------------------------

def scoreable_rows(features: DataFrame, names: list[str], zero: list[str] | None = None,
                   order: str | None = None) -> DataFrame:
    """Rows with every model feature known.  A feature listed in ``zero`` is set to
    0 first, which can let a row in that lacked it."""
    d = features if order is None else features.groupBy("ticker", "date").agg(
        F.max_by(F.struct(*names), order).alias("f")).select("ticker", "date", "f.*")
    value = lambda n: F.lit(0.0) if n in (zero or []) else F.col(n).cast("double")
    d = d.select("ticker", "date", *[value(n).alias(n) for n in names])
    known = F.lit(True)
    for n in names:
        known = known & F.col(n).isNotNull() & ~F.isnan(n)
    return d.filter(known)


def linear_scores(rows: DataFrame, weights: dict[str, float], intercept: float = 0.0) -> DataFrame:
    """A linear model stays inside codegen."""
    alpha = F.lit(float(intercept))
    for n, w in weights.items():
        alpha = alpha + F.col(n) * float(w)
    return rows.select("ticker", "date", rnd(alpha, 6).alias("alpha"))


def batch_scores(rows: DataFrame, names: list[str], predict) -> DataFrame:
    """Any model with a vectorised ``predict(matrix)``: one call per Arrow batch."""

    def score(batches):
        for b in batches:
            yield pd.DataFrame({"ticker": b["ticker"], "date": b["date"],
                                "alpha": predict(b[names].to_numpy(dtype="float64"))})

    return rows.select("ticker", "date", *names).mapInPandas(score, "ticker string, date date, alpha double")
