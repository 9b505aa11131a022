"""Runs of the same signals under several variants: models, cut-offs and weightings, side by side.

Every variant becomes one series of daily returns, (variant, date, ret), all of them made in one pass over the signals.
The series are compounded to a NAV and judged by the same statistics as a portfolio; two variants are compared date by
date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.scalars import rnd
from assay.operators.portfolio import nav_statistics

PAST = Window.unboundedPreceding
CASH = 1_000_000.0


def model_series(rows: DataFrame, scores: dict[str, Column], ret: str, top_n: int) -> DataFrame:
    """(variant, date, ret, n): mean return of each day's ``top_n`` rows under each model.

    ``rows`` (ticker, date, ...) is read once; a model is a column, and a row that a model cannot score (NULL) is none of
    its signals. Top rows are chosen before their outcome is looked at; unknown outcomes leave the mean. Ties go to the
    smaller ticker.
    """
    long = rows.select("ticker", "date", F.col(ret).alias("__ret"), F.inline(F.array(*[
        F.struct(F.lit(name).alias("variant"), score.cast("double").alias("score")) for name, score in scores.items()])))
    place = F.row_number().over(Window.partitionBy("variant", "date").orderBy(F.desc("score"), "ticker"))
    top = long.filter("score IS NOT NULL").withColumn("place", place).filter(F.col("place") <= top_n)
    return top.groupBy("variant", "date").agg(F.coalesce(F.avg("__ret"), F.lit(0.0)).alias("ret"), F.count("*").alias("n"))


def cutoff_series(signals: DataFrame, cutoffs: list[float], top_n: int) -> DataFrame:
    """(cutoff, date, ret, n): mean forward return of each day's ``top_n`` signals among those that reach the cut-off.

    ``signals``: (ticker, date, alpha, score, fwd). A cut-off of 0 keeps every signal. As the cut-off rises a signal moves
    up, since rivals drop out, enters the top once, and leaves when the cut-off passes its own alpha: it belongs to a
    range of cut-offs. One window per date counts, for all cut-offs together, the rivals ahead of each signal; only rows
    that are in some range go on, and a date without signals earns 0.
    """
    ordered = sorted(cutoffs)
    passes = [F.lit(True) if c <= 0 else F.coalesce(F.col("alpha") >= c, F.lit(False)) for c in ordered]
    ahead = Window.partitionBy("date").orderBy(F.desc("score"), "ticker").rowsBetween(PAST, 0)
    d = signals.withColumns({f"__n{i}": F.count(F.when(p, 1)).over(ahead) for i, p in enumerate(passes)})
    chosen = F.array_compact(F.array(*[F.when(p & (F.col(f"__n{i}") <= top_n), F.lit(c)) for i, (p, c) in enumerate(zip(passes, ordered))]))
    spread = d.select("date", "fwd", F.explode(chosen).alias("cutoff"))
    daily = spread.groupBy("cutoff", "date").agg(F.avg("fwd").alias("ret"), F.count("*").alias("n"))
    spine = signals.select("date").distinct().withColumn("cutoff", F.explode(F.array(*[F.lit(c) for c in ordered])))
    return spine.join(daily, ["cutoff", "date"], "left").select(
        "cutoff", "date", F.coalesce("ret", F.lit(0.0)).alias("ret"), F.coalesce("n", F.lit(0)).alias("n"))


def weighting_series(trades: DataFrame) -> DataFrame:
    """(variant, date, ret, alpha, n): the day's entries at their own sizes ('sized') and at equal ones ('equal').

    ``trades``: (date, ret, alpha, weight) of entries with a known result. Both variants put the same total to work, at
    most all of it.
    """
    w, gross = F.col("weight"), F.sum("weight")
    scale = F.greatest(gross, F.lit(1.0))
    day = trades.groupBy("date").agg(
        F.count("*").alias("n"), *[F.sum(w * F.col(c)).alias(f"own_{c}") for c in ("ret", "alpha")],
        *[(F.avg("weight") * F.sum(c)).alias(f"even_{c}") for c in ("ret", "alpha")], scale.alias("scale"))
    one = lambda name, k: F.struct(F.lit(name).alias("variant"), *[
        (F.col(f"{k}_{c}") / F.col("scale")).alias(c) for c in ("ret", "alpha")])
    return day.select("date", F.col("n"), F.inline(F.array(one("sized", "own"), one("equal", "even"))))


def series_nav(daily: DataFrame, variant: str = "variant") -> DataFrame:
    """(variant, date, nav): returns compounded from CASH; a loss of everything stays just above zero."""
    w = Window.partitionBy(variant).orderBy("date").rowsBetween(PAST, 0)
    growth = F.sum(F.log(F.greatest(1 + F.col("ret"), F.lit(1e-9)))).over(w)
    return daily.select(variant, "date", (CASH * F.exp(growth)).alias("nav"))


def series_statistics(daily: DataFrame, variant: str = "variant") -> DataFrame:
    """n_dates, total_return, sharpe_ratio, max_drawdown and calmar_ratio per variant."""
    nav = series_nav(daily, variant).withColumnRenamed(variant, "combo_id")
    return nav_statistics(nav, CASH).select(F.col("combo_id").alias(variant), "n_dates", *[
        rnd(c, 6).alias(c) for c in ("total_return", "sharpe_ratio", "max_drawdown", "calmar_ratio")])


def paired_statistics(daily: DataFrame, first: str, second: str) -> DataFrame:
    """One row: on how many dates both variants have a return, the mean of second - first, and its t statistic."""
    at = lambda v: F.max(F.when(F.col("variant") == v, F.col("ret")))
    both = daily.groupBy("date").agg(at(first).alias("a"), at(second).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    diff = F.col("b") - F.col("a")
    row = both.agg(F.count("*").alias("n_paired"), F.avg(diff).alias("m"), F.stddev_samp(diff).alias("s"))
    t = F.when(F.col("s") > 1e-15, F.col("m") / F.col("s") * F.sqrt(F.col("n_paired").cast("double")))
    return row.select("n_paired", rnd("m", 8).alias("mean_diff"), rnd(t, 4).alias("t_stat"))
