"""Permutation test of the alpha of the top-scored signals.

Shuffling scores over all rows and taking the N best per date picks N rows of
each date at random.  So a permutation draws N different places of each date
from hashes of (seed, permutation, date, draw), and the rows, numbered once per
date, are joined on (date, place): dates x permutations x N rows, however many
signals there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.frames import with_scalars
from assay.functions.scalars import ratio, rnd


def top_n_alpha(signals: DataFrame, top_n: int, groups: list[str] | None = None, order=None) -> DataFrame:
    """Mean over dates of (mean return - mean benchmark) of the N first rows per date.

    ``signals``: (ticker, date, score, stock_return, spy_return); the order is the
    score, ties by ticker, unless given.
    """
    keys = groups or []
    w = Window.partitionBy(*keys, "date").orderBy(*(order or [F.col("score").desc(), F.col("ticker")]))
    picked = signals.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= top_n)
    per_date = picked.groupBy(*keys, "date").agg(
        (F.avg("stock_return") - F.avg("spy_return")).alias("a"))
    return per_date.groupBy(*keys).agg(F.avg("a").alias("alpha"), F.count("*").alias("n_dates"))


def eligible(signals: DataFrame, min_score: float) -> DataFrame:
    known = signals.filter(
        F.col("score").isNotNull() & F.col("date").isNotNull() & F.col("stock_return").isNotNull()
        & F.col("spy_return").isNotNull())
    return known.filter(F.col("score") >= min_score)


#: Draws that one hash serves, 24 bits each.
DRAWS = 5
#: Tasks that the dates are dealt to before they draw.
DATE_PARTS = 64


def null_alphas(signals: DataFrame, n_permutations: int, top_n: int, seed: int) -> DataFrame:
    """(perm, alpha): the statistic under shuffled scores.

    Places are drawn without repeats: draw k is uniform over the first
    n - N + k + 1 places, and one that was taken before becomes the last of them.

    The dates are few and their draws many, which no size estimate shows: dates are dealt out before they are multiplied,
    and the join is a merge, as a broadcast would bring every draw through the driver.
    """
    in_date = Window.partitionBy("date").orderBy("ticker", "stock_return", "spy_return", "score")
    numbered = signals.select("date", "stock_return", "spy_return", (F.row_number().over(in_date) - 1).cast("long").alias("place"))
    d = signals.groupBy("date").agg(F.count("*").alias("n")).repartition(DATE_PARTS, "date").withColumn(
        "perm", F.explode(F.sequence(F.lit(0), F.lit(n_permutations - 1))))
    drawn: list[str] = []
    for k in range(top_n):
        if k % DRAWS == 0:
            d = d.withColumn("__k", F.md5(F.concat_ws(
                "|", F.lit(str(seed)), F.col("perm").cast("string"), F.col("date").cast("string"), F.lit(str(k // DRAWS)))))
        last = F.col("n") - (top_n - k)
        d = d.withColumn("__t", F.conv(F.substring("__k", 1 + 6 * (k % DRAWS), 6), 16, 10).cast("long") % F.greatest(last + 1, F.lit(1)))
        taken = F.col("__t").isin(*[F.col(c) for c in drawn]) if drawn else F.lit(False)
        d = d.withColumn(f"__p{k}", F.when(taken, last).otherwise(F.col("__t")))
        drawn.append(f"__p{k}")
    places = F.when(F.col("n") <= top_n, F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).otherwise(F.array(*drawn))
    picks = d.select("perm", "date", F.explode(places).alias("place")).hint("merge").join(numbered, ["date", "place"])
    per_date = picks.groupBy("perm", "date").agg((F.avg("stock_return") - F.avg("spy_return")).alias("a"))
    return per_date.groupBy("perm").agg(F.avg("a").alias("alpha"))


def permutation_test(signals: DataFrame, n_permutations: int = 1000, top_n: int = 5, min_score: float = 70.0,
                     seed: int = 42, min_signals: int = 20, min_dates: int = 5) -> DataFrame:
    """One row: actual alpha, p-value, percentile and the null distribution's shape."""
    known = signals.filter(F.col("score").isNotNull() & F.col("stock_return").isNotNull() & F.col("spy_return").isNotNull())
    buys = eligible(signals, min_score)
    actual = top_n_alpha(buys, top_n).select(F.col("alpha").alias("actual"), F.col("n_dates").alias("n_signal_dates"))
    counts = known.agg(F.count("*").alias("n_known"), F.count_if(F.col("score") >= min_score).alias("n_signals"))
    nulls = null_alphas(buys, n_permutations, top_n, seed)
    row = with_scalars(nulls, actual, counts).groupBy("actual", "n_signal_dates", "n_known", "n_signals").agg(
        F.count("*").alias("n_permutations"), F.count_if(F.col("alpha") >= F.col("actual")).alias("ge"),
        F.avg("alpha").alias("m"), F.stddev_pop("alpha").alias("s"), F.min("alpha").alias("lo"), F.max("alpha").alias("hi"))
    p = ratio(F.col("ge"), F.col("n_permutations"))
    ok = (F.col("n_known") >= min_signals) & (F.col("n_signal_dates") >= min_dates)
    return row.select(
        F.when(ok, "ok").otherwise("insufficient_data").alias("status"), rnd("actual", 4).alias("actual_alpha"),
        rnd(p, 4).alias("p_value"), rnd((1 - p) * 100, 1).alias("percentile"), rnd("m", 4).alias("null_mean"),
        rnd("s", 4).alias("null_std"), rnd("lo", 4).alias("null_min"), rnd("hi", 4).alias("null_max"),
        "n_permutations", "n_signals", "n_signal_dates",
        F.when(p < 0.05, "significant").otherwise("not_significant").alias("conclusion"))
