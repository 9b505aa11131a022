"""Price and feature tables: loading, freshness, gaps, coverage.

The long table (ticker, date, ...) replaces one frame per ticker.  Duplicate
rows are reduced with ``max_by``, which combines map-side, so an over-full
(ticker, date) never lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.frames import with_scalars
from assay.functions.scalars import ratio, rnd

OHLCV = ["open", "high", "low", "close", "volume", "vwap"]
# Benchmark, volatility, rate and commodity series, and sector funds.
MACRO = ["SPY", "VIX", "VIX3M", "TNX", "IRX", "GLD", "USO"]
SECTOR_FUNDS = ["XLB", "XLC", "XLE", "XLF", "XLI", "XLK", "XLP", "XLRE", "XLU", "XLV", "XLY"]


def _day(asof) -> Column:
    return F.lit(asof).cast("date") if isinstance(asof, str) else asof


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one with the largest ``order``."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(*keys, "__r.*")


def normalise_ohlc(df: DataFrame, order: str | None = None) -> DataFrame:
    """Lower-case names, missing open / high / low taken from the close, one row per day."""
    d = df.withColumnsRenamed({c: c.lower() for c in df.columns})
    close = F.col("close").cast("double")
    have = lambda c: F.coalesce(F.col(c).cast("double"), close) if c in d.columns else close
    cols = {c: have(c) for c in ("open", "high", "low")}
    if order:
        d = keep_last(d, ["ticker", "date"], order)
    return d.filter(close.isNotNull()).select(
        "ticker", "date", *[v.alias(k) for k, v in cols.items()], close.alias("close"))


def load_universe(table: DataFrame, macro: DataFrame, order: str, allowlist: DataFrame | None = None,
                  macro_symbols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(prices, features): an allowlist limits the stocks but never the macro series;
    a macro series missing from the main table comes from the macro table."""
    always = (macro_symbols or MACRO + SECTOR_FUNDS)
    is_macro = F.col("ticker").isin(always)
    if allowlist is not None:
        allowed = allowlist.select("ticker").distinct().withColumn("__ok", F.lit(True))
        table = table.join(allowed, "ticker", "left").filter(
            is_macro | F.coalesce("__ok", F.lit(False))).drop("__ok")
    rows = keep_last(table, ["ticker", "date"], order).drop(order)
    price_cols = ["ticker", "date", *[c for c in OHLCV if c in rows.columns]]
    have = rows.filter(is_macro).select("ticker").distinct()
    extra = keep_last(macro.filter(is_macro), ["ticker", "date"], order).join(have, "ticker", "left_anti")
    prices = rows.select(*price_cols).unionByName(
        extra.select(*[c for c in price_cols if c in extra.columns]), allowMissingColumns=True)
    return prices, rows.filter(~is_macro)


def read_quality(expected: DataFrame, prices: DataFrame, limit: float = 0.05) -> DataFrame:
    """Share of expected series without a row, and whether that is too much.  One row."""
    have = prices.select("ticker").distinct().withColumn("__have", F.lit(1))
    row = expected.select("ticker").distinct().join(have, "ticker", "left").agg(
        F.count("*").alias("n_expected"), F.count_if(F.col("__have").isNull()).alias("n_missing"))
    share = F.coalesce(ratio(F.col("n_missing"), F.col("n_expected")), F.lit(0.0))
    return row.withColumn("error_rate", rnd(share, 4)).withColumn(
        "status", F.when(F.col("n_expected") == 0, "empty_universe").when(share > limit, "failed").otherwise("ok"))


def require_quality(df: DataFrame, quality: DataFrame) -> DataFrame:
    """Pass rows through only while the gate holds; otherwise the job fails with its reason."""
    gate = quality.select(F.when(F.col("status") == "ok", True).otherwise(
        F.raise_error(F.concat(F.lit("price read gate: "), "status"))).alias("__gate"))
    return with_scalars(df, gate).filter("__gate").drop("__gate")


def with_fallback(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of the first source, plus the series only the second one has."""
    missing = second.join(first.select("ticker").distinct(), "ticker", "left_anti")
    return first.unionByName(missing.select(*first.columns))


def feature_scan(features: DataFrame, tickers: DataFrame, exclude: list[str] = OHLCV) -> DataFrame:
    keep = [c for c in features.columns if c not in exclude]
    return features.select(*keep).join(tickers.select("ticker").distinct(), "ticker", "left_semi")


def history_until(bars: DataFrame, wanted: DataFrame, until) -> DataFrame:
    """Bars up to a date for the tickers asked for (held, candidate, universe, sector funds)."""
    return bars.filter(F.col("date") <= _day(until)).join(wanted.select("ticker").distinct(), "ticker", "left_semi")


def stale_series(bars: DataFrame, asof, days: int) -> DataFrame:
    """Series whose last bar is older than ``days``, stalest first."""
    return (
        bars.groupBy("ticker").agg(F.max("date").alias("last_date"))
        .withColumn("age_days", F.datediff(_day(asof), "last_date"))
        .filter(F.col("age_days") > days)
        .orderBy(F.col("age_days").desc(), "ticker")
    )


def benchmark_fresh(bars: DataFrame, ticker: str, required) -> DataFrame:
    row = bars.filter(F.col("ticker") == ticker).agg(F.max("date").alias("last_date"))
    return row.withColumn("fresh", F.coalesce(F.col("last_date") >= _day(required), F.lit(False)))


def business_days_before(day: Column, n: int) -> Column:
    """The n-th weekday strictly before a date."""
    back = F.sequence(F.date_sub(day, 2 * n + 7), F.date_sub(day, 1))
    return F.element_at(F.filter(back, lambda d: ~F.dayofweek(d).isin(1, 7)), -n)


def staleness_tier(bars: DataFrame, asof, warn: int = 2, stop: int = 5) -> DataFrame:
    """ok / warn / break by business days since the last bar of the whole table."""
    row = bars.agg(F.max("date").alias("last_date"))
    day = _day(asof)
    return row.withColumn("tier", F.when(F.col("last_date") < business_days_before(day, stop), "break").when(
        F.col("last_date") < business_days_before(day, warn), "warn").otherwise("ok"))


def heartbeats(modules: DataFrame, beats: DataFrame, now, max_age_hours: int = 48) -> DataFrame:
    """Last sign of life per module; a silent module is unknown and counts as stale."""
    last = beats.groupBy("module").agg(F.max("ts").alias("last_ts"))
    at = F.lit(now).cast("timestamp") if isinstance(now, str) else now
    age = (F.unix_timestamp(at) - F.unix_timestamp("last_ts")) / 3600.0
    return modules.join(last, "module", "left").select(
        "module", F.when(F.col("last_ts").isNull(), "unknown").otherwise("seen").alias("state"),
        rnd(age, 4).alias("age_hours"), F.coalesce(age > max_age_hours, F.lit(True)).alias("stale"))


def trading_dates(features: DataFrame, least: int, most: int) -> DataFrame:
    """The most recent dates of the table; none at all below the minimum."""
    days = features.select("date").filter(F.col("date").isNotNull()).distinct()
    enough = days.agg((F.count("*") >= least).alias("__ok"))
    latest = days.orderBy(F.col("date").desc()).limit(most)
    return with_scalars(latest, enough).filter("__ok").drop("__ok")


def price_matrix(bars: DataFrame, cal: DataFrame, limit: int = 5, backfill: bool = True) -> DataFrame:
    """(ticker, date, price, filled): closes on every calendar day.

    An observed close is carried at most ``limit`` days; what is left of a gap
    takes the next close when ``backfill`` is on (this looks ahead; switch it off
    for leak-free prices).  Each row is exploded to the days it serves, so no
    date x ticker grid is built first and no frame slides over one.  The calendar
    has a row per day and is sent whole: the filled days are never shuffled.
    """
    last = cal.agg(F.max("pos").alias("last"))
    w = Window.partitionBy("ticker").orderBy("pos")
    obs = with_scalars(
        bars.filter(F.col("close").isNotNull()).select("ticker", "date", "close")
        .join(F.broadcast(cal.select("date", "pos")), "date")
        .withColumns({"prev": F.lag("pos").over(w), "next": F.lead("pos").over(w)}), last)
    stop = F.coalesce(F.col("next") - 1, F.col("last"))
    own = F.sequence("pos", F.least(F.col("pos") + limit, stop))
    forward = obs.select("ticker", F.explode(own).alias("at"), F.col("close").alias("price"),
                         F.col("pos").alias("src"))
    parts = forward.select("ticker", "at", "price",
                           F.when(F.col("at") == F.col("src"), "observed").otherwise("forward").alias("filled"))
    if backfill:
        start = F.coalesce(F.col("prev") + limit + 1, F.lit(0))
        gap = obs.filter(start < F.col("pos")).select(
            "ticker", F.explode(F.sequence(start, F.col("pos") - 1)).alias("at"), F.col("close").alias("price"))
        parts = parts.unionByName(gap.withColumn("filled", F.lit("backward")))
    return parts.withColumnRenamed("at", "pos").join(F.broadcast(cal.select("pos", "date")), "pos").drop("pos")


def gap_statistics(bars: DataFrame, cal: DataFrame, limit: int = 5, backfill: bool = True,
                   warn_above: int = 5) -> DataFrame:
    """Missing days per ticker, the longest tail, and whether the ticker must be dropped."""
    size = cal.agg(F.count("*").alias("n_days"), F.max("pos").alias("last"))
    w = Window.partitionBy("ticker").orderBy("pos")
    obs = bars.filter(F.col("close").isNotNull()).select("ticker", "date").join(cal.select("date", "pos"), "date")
    over = F.greatest(F.col("pos") - F.lag("pos").over(w) - 1 - limit, F.lit(0))
    row = with_scalars(
        obs.withColumn("over", F.coalesce(over, F.lit(0)))
        .groupBy("ticker")
        .agg(F.count("*").alias("n_seen"), F.min("pos").alias("first"), F.max("pos").alias("final"),
             F.sum("over").alias("inner")), size)
    tail = F.greatest(F.col("last") - F.col("final") - limit, F.lit(0))
    unfilled = tail if backfill else tail + F.col("first") + F.col("inner")
    return row.select(
        "ticker", (F.col("n_days") - F.col("n_seen")).alias("n_missing"), unfilled.alias("n_unfilled"),
        (F.col("n_days") - F.col("n_seen") > warn_above).alias("gap_warning"), (unfilled > 0).alias("dropped"))


def drop_unfilled(matrix: DataFrame, gaps: DataFrame) -> DataFrame:
    return matrix.join(gaps.filter("dropped").select("ticker"), "ticker", "left_anti")


def fill_rate(bars: DataFrame, cal: DataFrame) -> DataFrame:
    """Share of the date x ticker cells that hold a price."""
    obs = bars.filter(F.col("close").isNotNull()).join(cal.select("date"), "date", "left_semi")
    seen = obs.select("ticker", "date").distinct().groupBy("ticker").agg(F.count("*").alias("n"))
    row = seen.agg(F.count("*").alias("n_tickers"), F.sum("n").alias("n_filled"))
    days = cal.agg(F.count("*").alias("n_dates"))
    return with_scalars(row, days).withColumn(
        "fill_rate", rnd(ratio(F.col("n_filled"), F.col("n_tickers") * F.col("n_dates")), 4))


def latest_features(features: DataFrame, exclude: list[str] = OHLCV) -> DataFrame:
    """Per ticker: last positive ATR of the final row and the share of known features in it."""
    cols = [c for c in features.columns if c not in exclude and c not in ("ticker", "date")]
    last = features.groupBy("ticker").agg(
        F.max("date").alias("last_date"), F.max_by(F.struct(*cols), "date").alias("f"))
    known = sum((F.col(f"f.{c}").isNotNull().cast("int") for c in cols), F.lit(0))
    atr = F.col("f.atr_14_pct") if "atr_14_pct" in cols else F.lit(None).cast("double")
    return last.select("ticker", "last_date", F.when(atr > 0, atr).alias("atr_14_pct"),
                       rnd(ratio(known, F.lit(len(cols))), 4).alias("coverage"))


def simulation_coverage(expected: DataFrame, done: DataFrame, limit: float = 0.8) -> DataFrame:
    """Share of the expected dates that were processed, and whether that suffices."""
    d = expected.select("date").distinct().join(
        done.select("date").distinct().withColumn("__done", F.lit(1)), "date", "left")
    row = d.agg(F.count("*").alias("n_expected"), F.count("__done").alias("n_done"))
    share = F.coalesce(ratio(F.col("n_done"), F.col("n_expected")), F.lit(0.0))
    return row.withColumn("coverage", rnd(share, 4)).withColumn(
        "status", F.when(share < limit, "insufficient_coverage").otherwise("ok"))


def skip_reasons(expected: DataFrame, signals: DataFrame, prices: DataFrame) -> DataFrame:
    """Why an expected date was not simulated, counted per reason."""
    def flag(df, name):
        return df.select("date").distinct().withColumn(name, F.lit(1))

    d = expected.select("date").distinct().join(flag(signals, "s"), "date", "left").join(
        flag(prices, "p"), "date", "left")
    return d.withColumn("reason", F.when(F.col("s").isNull(), "no_signals").when(
        F.col("p").isNull(), "no_prices").otherwise("simulated")).groupBy("reason").agg(F.count("*").alias("n_dates"))
