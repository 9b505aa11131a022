"""As-of, interval and calendar joins.

An inequality join on a ticker compares every pair of rows of that ticker.
None of the operators here do that: a backward as-of is a union and one window
over the distinct (key, date) pairs (so a ticker contributes at most one row
per day and side, however many rows it has), an interval look-up goes through
calendar months, and a forward fill explodes each row to the days it covers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.frames import with_scalars

LAST = Window.unboundedPreceding


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], left_date: str, right_date: str,
                  values: list[str], tie: str | None = None, matched_date: str = "matched_date") -> DataFrame:
    """Attach to every left row the values of the latest right row on or before its date.

    ``by`` names are the same on both sides.  Several right rows of one (by,
    date) are reduced to the one with the largest ``tie`` first, or with the
    largest values where no tie column is named.
    """
    payload = F.struct(F.col(right_date).alias(matched_date), *values)
    points = right.filter(F.col(right_date).isNotNull()).groupBy(*by, F.col(right_date).alias("__d")).agg(
        (F.max_by(payload, tie) if tie else F.max(payload)).alias("__v"))
    asked = left.select(*by, F.col(left_date).alias("__d")).distinct()
    both = points.withColumn("__ask", F.lit(False)).unionByName(
        asked.withColumns({"__v": F.lit(None).cast(points.schema["__v"].dataType), "__ask": F.lit(True)}))
    w = Window.partitionBy(*by).orderBy("__d", "__ask").rowsBetween(LAST, 0)
    answers = (
        both.withColumn("__v", F.last("__v", ignorenulls=True).over(w))
        .filter("__ask")
        .select(*by, F.col("__d").alias(left_date), "__v.*")
    )
    return left.join(answers, [*by, left_date], "left")


def calendar(df: DataFrame, date_col: str = "date", keep_last: int | None = None) -> DataFrame:
    """Distinct dates with their position; the window is over calendar days only."""
    days = df.select(F.col(date_col).alias("date")).filter(F.col("date").isNotNull()).distinct()
    if keep_last is not None:
        days = days.orderBy(F.col("date").desc()).limit(keep_last)
    w = Window.partitionBy(F.lit(0)).orderBy("date")
    return days.withColumns({"pos": F.row_number().over(w) - 1, "next_date": F.lead("date").over(w)})


def next_trading_day(dates: DataFrame, cal: DataFrame, date_col: str = "date") -> DataFrame:
    """First calendar day on or after each distinct date."""
    asked = dates.select(F.col(date_col).alias("date")).distinct()
    both = asked.withColumns({"day": F.lit(None).cast("date"), "k": F.lit(0)}).unionByName(
        cal.select("date", F.col("date").alias("day"), F.lit(1).alias("k")))
    w = Window.partitionBy(F.lit(0)).orderBy("date", "k").rowsBetween(0, Window.unboundedFollowing)
    return both.withColumn("trading_date", F.first("day", ignorenulls=True).over(w)).filter("k = 0").select(
        F.col("date").alias(date_col), "trading_date")


def shift_entries_to_next_day(orders: DataFrame, cal: DataFrame, date_col: str = "date") -> DataFrame:
    """Entries fill on the following trading day; an entry without one is dropped."""
    nxt = cal.select(F.col("date").alias(date_col), "next_date")
    joined = orders.join(nxt, date_col, "left")
    enters = F.col("action") == "ENTER"
    return (
        joined.withColumn("fill_date", F.when(enters, F.col("next_date")).otherwise(F.col(date_col)))
        .filter(F.col("fill_date").isNotNull())
        .drop("next_date")
    )


def carry_signals(signals: DataFrame, cal: DataFrame, date_col: str = "date") -> DataFrame:
    """Signals for every trading day: own signals, else those of the last day that
    had any, without the buy bucket."""
    own = signals.select(F.col(date_col).alias("date")).distinct().withColumn("src", F.col("date"))
    w = Window.partitionBy(F.lit(0)).orderBy("date").rowsBetween(LAST, 0)
    source = (
        cal.select("date").join(own, "date", "full")
        .withColumn("src", F.last("src", ignorenulls=True).over(w))
        .join(cal.select("date"), "date", "left_semi")
        .filter(F.col("src").isNotNull())
    )
    rows = signals.withColumnRenamed(date_col, "src").join(source, "src")
    return rows.filter((F.col("src") == F.col("date")) | (F.col("bucket") != "buy")).withColumnRenamed(
        "src", "signal_date")


def interval_extremes(trades: DataFrame, bars: DataFrame, trade_id: str, entry: str, exit_: str) -> DataFrame:
    """(trade_id, max_high, min_low, n_bars) over the bars inside [entry, exit].

    The two edge months are read bar by bar, the months in between through one
    aggregate row each, so a long holding does not touch each of its bars.
    """
    month = lambda c: F.trunc(c, "MM")
    span = trades.select(
        "ticker", F.col(trade_id).alias("__id"), F.col(entry).alias("__a"), F.col(exit_).alias("__b"),
    ).filter(F.col("__a") <= F.col("__b"))
    months = span.withColumn("month", F.explode(F.sequence(
        month("__a"), month("__b"), F.expr("interval 1 month"))))
    edge = (F.col("month") == month("__a")) | (F.col("month") == month("__b"))
    keyed = bars.select("ticker", "date", "high", "low").withColumn("month", month("date"))
    monthly = keyed.groupBy("ticker", "month").agg(
        F.max("high").alias("hi"), F.min("low").alias("lo"), F.count("*").alias("n"))
    near = months.filter(edge).join(keyed, ["ticker", "month"]).filter(
        F.col("date").between(F.col("__a"), F.col("__b"))
    ).select("__id", F.col("high").alias("hi"), F.col("low").alias("lo"), F.lit(1).cast("bigint").alias("n"))
    far = months.filter(~edge).join(monthly, ["ticker", "month"]).select("__id", "hi", "lo", "n")
    return near.unionByName(far).groupBy(F.col("__id").alias(trade_id)).agg(
        F.max("hi").alias("max_high"), F.min("lo").alias("min_low"), F.sum("n").alias("n_bars"))


def last_positive_within(df: DataFrame, by: str, date_col: str, value: str, rows: int = 5,
                         out: str = "recent") -> DataFrame:
    """Last positive value among the last ``rows`` rows of the series, row by row."""
    w = Window.partitionBy(by).orderBy(date_col).rowsBetween(-(rows - 1), 0)
    return df.withColumn(out, F.last(F.when(F.col(value) > 0, F.col(value)), ignorenulls=True).over(w))


def vwap_for_dates(features: DataFrame, asked: DataFrame, max_lookback: int = 5) -> DataFrame:
    """Usable VWAP on or before each asked (ticker, date), within the last rows only."""
    recent = last_positive_within(features, "ticker", "date", "vwap", max_lookback, "vwap_used")
    return asof_backward(asked, recent.select("ticker", "date", "vwap_used"), ["ticker"], "date", "date",
                         ["vwap_used"])


def carry_forward(df: DataFrame, cal: DataFrame, values: list[str], by: str = "ticker",
                  date_col: str = "date") -> DataFrame:
    """Dense (by, date) table: each row is repeated until the series' next row.

    Positions before the first row of a series are absent; a carried row keeps
    its NULLs.
    """
    last = cal.agg(F.max("pos").alias("__last"))
    placed = df.select(by, F.col(date_col).alias("date"), *values).join(cal.select("date", "pos"), "date")
    nxt = F.lead("pos").over(Window.partitionBy(by).orderBy("pos"))
    spread = (
        with_scalars(placed.withColumn("__next", nxt), last)
        .withColumn("pos", F.explode(F.sequence("pos", F.coalesce(F.col("__next") - 1, F.col("__last")))))
        .select(by, "pos", F.col("date").alias("source_date"), *values)
    )
    return spread.join(cal.select("pos", "date"), "pos").drop("pos")


def within_last_dates(df: DataFrame, date: Column, n: int) -> DataFrame:
    """Rows whose date is one of the n latest distinct dates."""
    tagged = df.withColumn("__day", date)
    days = tagged.select("__day").filter(F.col("__day").isNotNull()).distinct().orderBy(
        F.col("__day").desc()).limit(n)
    return tagged.join(days, "__day", "left_semi").drop("__day")
