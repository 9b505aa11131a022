"""Signal quality: accuracy by slice, alpha distribution, calibration, attribution.

Input is a table of scored signals with, per horizon h in 5d / 10d / 30d, the
columns return_h, spy_h_return and beat_spy_h (0 / 1 / NULL while unresolved).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.aggregates import pearson, sample_skewness
from assay.functions.frames import with_scalars
from assay.functions.ranks import exact_quantiles
from assay.functions.scalars import (
    bucket_right_open, net_signal, proportion_p_value, ratio, rnd, wilson_bounds,
)
from assay.functions.significance import benjamini_hochberg, pearson_p_value

HORIZONS = ("5d", "10d", "30d")
MIN_SAMPLES = 30
SCORE_BUCKETS = [("60-70", 60, 70), ("70-80", 70, 80), ("80-90", 80, 90), ("90+", 90, 101)]
THRESHOLDS = [60, 65, 70, 72, 75, 78, 80, 85, 90]
ALPHA_BUCKETS = [
    ("<-5%", float("-inf"), -5.0), ("-5% to -2%", -5.0, -2.0), ("-2% to 0%", -2.0, 0.0),
    ("0% to +2%", 0.0, 2.0), ("+2% to +5%", 2.0, 5.0), (">+5%", 5.0, float("inf")),
]


def with_sector(signals: DataFrame, sectors: DataFrame) -> DataFrame:
    """Left-join the distinct (ticker, sector) pairs; a ticker with two sectors fans out."""
    pairs = (
        sectors.filter(F.col("sector").isNotNull() & (F.col("sector") != ""))
        .select(F.col("ticker").alias("symbol"), "sector")
        .distinct()
    )
    return signals.join(pairs, "symbol", "left")


def with_regime(signals: DataFrame, macro: DataFrame) -> DataFrame:
    regime = macro.select(F.col("date").alias("score_date"), "market_regime")
    return signals.join(regime, "score_date", "left")


def slice_metrics() -> list[Column]:
    """Accuracy, interval, mean alpha and counts per horizon; a row counts toward
    a horizon only once its flag is resolved."""
    out: list[Column] = []
    for h in HORIZONS:
        beat = F.col(f"beat_spy_{h}")
        n, wins = F.count(beat), F.coalesce(F.sum(beat), F.lit(0))
        lo, hi = wilson_bounds(wins, n)
        some = n > 0
        out += [
            rnd(F.avg(beat), 6).alias(f"accuracy_{h}"),
            F.when(some, lo).alias(f"ci_low_{h}"),
            F.when(some, hi).alias(f"ci_high_{h}"),
            rnd(F.avg(F.when(beat.isNotNull(), F.col(f"return_{h}") - F.col(f"spy_{h}_return"))), 6)
            .alias(f"avg_alpha_{h}"),
            n.alias(f"n_{h}"),
        ]
    beat = F.col("beat_spy_10d")
    out += [
        rnd(F.avg(beat), 4).alias("precision_10d"),
        F.coalesce(F.sum(beat), F.lit(0)).alias("tp_10d"),
        (F.count(beat) - F.coalesce(F.sum(beat), F.lit(0))).alias("fp_10d"),
    ]
    return out


def overall_accuracy(signals: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """One row; metrics are NULL under the sample gate and ``status`` says so."""
    row = signals.agg(*slice_metrics())
    enough = F.col("n_10d") >= min_samples
    counts = {f"n_{h}" for h in HORIZONS}
    return row.select(
        F.when(enough, "ok").otherwise("insufficient_data").alias("status"),
        *[F.col(c) if c in counts else F.when(enough, F.col(c)).alias(c) for c in row.columns],
    )


def accuracy_by_bucket(signals: DataFrame, exploratory_below: int = 20) -> DataFrame:
    """Per score bucket, with the buckets whose accuracy differs from a coin flip flagged."""
    rows = (
        signals.withColumn("bucket", bucket_right_open("score", SCORE_BUCKETS))
        .filter(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(*slice_metrics())
        .filter(F.col("n_10d") > 0)
        .withColumn("exploratory", F.col("n_10d") < exploratory_below)
        .withColumn("__p", proportion_p_value(F.col("accuracy_10d"), F.col("n_10d")))
    )
    flagged = benjamini_hochberg(rows, "__p", "__sig")
    return flagged.withColumn("fdr_exploratory", ~F.col("__sig")).drop("__p", "__sig")


def accuracy_by_field(signals: DataFrame, field: str) -> DataFrame:
    return (
        signals.filter(F.col(field).isNotNull())
        .groupBy(field)
        .agg(*slice_metrics())
        .filter(F.col("n_10d") > 0)
    )


def accuracy_by_regime(signals: DataFrame, macro: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    by_regime = accuracy_by_field(with_regime(signals, macro), "market_regime")
    # rows without a regime count for the gate, so it looks at all signals
    gate = signals.agg((F.count("beat_spy_10d") >= min_samples).alias("__enough"))
    return with_scalars(by_regime, gate).filter("__enough").drop("__enough")


def accuracy_by_threshold(
    signals: DataFrame, thresholds: list[float] = THRESHOLDS, min_samples: int = MIN_SAMPLES
) -> DataFrame:
    """Signals scoring at least T, for every T.

    A row is grouped once, under the highest threshold it reaches, and the
    cumulative rows are made from those few partial sums, so the input is not
    multiplied by the number of thresholds.
    """
    ordered = sorted(thresholds)
    reached = reduce(
        lambda acc, t: acc.when(F.col("score") >= t, float(t)),
        ordered[-2::-1],
        F.when(F.col("score") >= ordered[-1], float(ordered[-1])),
    )
    sums = []
    for h in HORIZONS:
        beat = F.col(f"beat_spy_{h}")
        excess = F.col(f"return_{h}") - F.col(f"spy_{h}_return")
        kept = F.when(beat.isNotNull(), excess)
        sums += [
            F.count(beat).alias(f"n_{h}"), F.sum(beat).alias(f"w_{h}"),
            F.sum(kept).alias(f"a_{h}"), F.count(kept).alias(f"m_{h}"),
        ]
    parts = signals.withColumn("threshold", reached).filter(F.col("threshold").isNotNull()) \
        .groupBy("threshold").agg(*sums)
    spine = signals.sparkSession.createDataFrame([(float(t),) for t in ordered], "threshold double")
    from_here = Window.orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, 0)
    total = spine.join(F.broadcast(parts), "threshold", "left")  # <= one row per threshold
    cols = [c for c in parts.columns if c != "threshold"]
    total = total.select("threshold", *[
        F.coalesce(F.sum(c).over(from_here), F.lit(0)).alias(c) for c in cols
    ])
    out = [F.col("threshold")]
    for h in HORIZONS:
        n, w = F.col(f"n_{h}"), F.col(f"w_{h}")
        lo, hi = wilson_bounds(w, n)
        out += [
            rnd(ratio(w, n), 6).alias(f"accuracy_{h}"),
            F.when(n > 0, lo).alias(f"ci_low_{h}"), F.when(n > 0, hi).alias(f"ci_high_{h}"),
            rnd(ratio(F.col(f"a_{h}"), F.col(f"m_{h}")), 6).alias(f"avg_alpha_{h}"),
            n.alias(f"n_{h}"),
        ]
    out += [
        rnd(ratio(F.col("w_10d"), F.col("n_10d")), 4).alias("precision_10d"),
        F.col("w_10d").alias("tp_10d"), (F.col("n_10d") - F.col("w_10d")).alias("fp_10d"),
    ]
    return total.select(*out).filter(F.col("n_10d") >= min_samples)


def optimal_threshold(signals: DataFrame, target: str = "accuracy_10d", min_n: int = 20,
                      thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """The threshold with the best target; ties go to the lowest threshold."""
    rows = accuracy_by_threshold(signals, thresholds, min_samples=1)
    return (
        rows.filter((F.col("n_10d") >= min_n) & F.col(target).isNotNull())
        .orderBy(F.col(target).desc(), "threshold")
        .limit(1)
    )


def alphas(signals: DataFrame, horizons=HORIZONS) -> DataFrame:
    """(horizon, alpha) in long form, one scan of the input."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(h).alias("horizon"),
                 (F.col(f"return_{h}") - F.col(f"spy_{h}_return")).alias("alpha"))
        for h in horizons
    ])).alias("x")
    return signals.select(pairs).select("x.*").filter(F.col("alpha").isNotNull())


def _alpha_buckets(signals: DataFrame, horizons) -> DataFrame:
    """A row per horizon and bucket, empty ones too, with the rows of the horizon in ``__n`` (NULL without any)."""
    long = alphas(signals, horizons)
    counts = long.withColumn("bucket", bucket_right_open("alpha", ALPHA_BUCKETS)) \
        .groupBy("horizon", "bucket").agg(F.count("*").alias("cnt"), F.avg("alpha").alias("mean"))
    spark = signals.sparkSession
    spine = spark.createDataFrame(
        [(h, i, b[0]) for h in horizons for i, b in enumerate(ALPHA_BUCKETS)],
        "horizon string, bucket_no int, bucket string",
    )
    total = F.sum("cnt").over(Window.partitionBy("horizon"))
    return (
        spine.join(F.broadcast(counts), ["horizon", "bucket"], "left")  # 6 rows per horizon
        .withColumn("__n", total)
        .select(
            "horizon", "bucket_no", "bucket",
            F.coalesce("cnt", F.lit(0)).alias("count"),
            rnd(ratio(F.coalesce("cnt", F.lit(0)), F.col("__n")), 4).alias("pct"),
            rnd("mean", 4).alias("avg_alpha"), "__n",
        )
    )


def alpha_distribution(signals: DataFrame, horizons=HORIZONS, min_samples: int = 5) -> DataFrame:
    """Count, share and mean per alpha bucket and horizon; empty buckets stay."""
    return _alpha_buckets(signals, horizons).filter(F.col("__n") >= min_samples).drop("__n")


def alpha_distribution_status(signals: DataFrame, horizons=HORIZONS, min_samples: int = 5) -> DataFrame:
    """A row per horizon and bucket whatever the gate says: status, n_samples, and the bucket's figures or NULLs."""
    n = F.coalesce("__n", F.lit(0))
    return _alpha_buckets(signals, horizons).select(
        "horizon", "bucket_no", "bucket", F.when(n >= min_samples, "ok").otherwise("insufficient_data").alias("status"),
        n.alias("n_samples"), *[F.when(n >= min_samples, F.col(c)).alias(c) for c in ("count", "pct", "avg_alpha")])


def alpha_summary(signals: DataFrame, horizons=HORIZONS, min_samples: int = 5) -> DataFrame:
    long = alphas(signals, horizons)
    stats = long.groupBy("horizon").agg(
        F.count("*").alias("n"),
        rnd(F.avg("alpha"), 4).alias("avg_alpha"),
        rnd(F.stddev_samp("alpha"), 4).alias("std_alpha"),
        rnd(sample_skewness(F.col("alpha")), 4).alias("skew"),
        rnd(F.avg(F.when(F.col("alpha") > 0, 1.0).otherwise(0.0)), 4).alias("pct_positive"),
    )
    median = exact_quantiles(long, ["horizon"], "alpha", [0.5]).select(
        "horizon", rnd("quantile", 4).alias("median_alpha"))
    return stats.join(median, "horizon").filter(F.col("n") >= min_samples)


def alpha_summary_status(signals: DataFrame, horizons=HORIZONS, min_samples: int = 5) -> DataFrame:
    """One row per horizon whatever the gate says: status, n_samples, and the summary or NULLs."""
    spine = signals.sparkSession.createDataFrame([(h,) for h in horizons], "horizon string")
    summary = alpha_summary(signals, horizons, 0)
    enough, n = F.col("n") >= min_samples, F.coalesce("n", F.lit(0))
    return spine.join(summary, "horizon", "left").select(
        "horizon", F.when(enough, "ok").otherwise("insufficient_data").alias("status"), n.alias("n_samples"),
        *[F.when(enough, F.col(c)).alias(c) for c in summary.columns if c not in ("horizon", "n")])


def score_calibration(signals: DataFrame, macro: DataFrame, horizon: str = "10d",
                      n_buckets: int = 5, min_per_bucket: int = 3) -> DataFrame:
    """Quantile bins of the score with their outcome, make-up and a monotonic flag.

    Edges are exact interpolated quantiles, bins are right-closed, equal edges
    collapse.  The edges are one row, attached as a scalar.  ``macro`` has one row
    per date.
    """
    ret, spy = f"return_{horizon}", f"spy_{horizon}_return"
    sub = signals.filter(
        F.col("score").isNotNull() & F.col(ret).isNotNull() & F.col(spy).isNotNull()
    ).withColumn("alpha", F.col(ret) - F.col(spy))
    probs = [i / n_buckets for i in range(n_buckets + 1)]
    edges = (
        exact_quantiles(sub, [], "score", probs)
        .agg(F.array_sort(F.collect_set("quantile")).alias("edges"))  # n_buckets + 1 values
    )
    binned = (
        with_scalars(with_regime(sub, macro), edges)
        # edges strictly below the score; the lowest score belongs to the first bin
        .withColumn("bin", F.greatest(F.size(F.filter("edges", lambda e: e < F.col("score"))), F.lit(1)))
        .withColumn("score_low", F.element_at("edges", F.col("bin")))
        .withColumn("score_high", F.element_at("edges", F.col("bin") + 1))
    )
    keys = ["bin", "score_low", "score_high"]
    # one pass counts every (bin, dimension, value), the bin itself being a dimension of one value;
    # means, distinct and top values all come from these counts
    dims = {"all": F.lit(""), "date": F.col("score_date").cast("string"), "symbol": F.col("symbol"),
            "sector": F.col("sector"), "regime": F.col("market_regime")}
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), c.alias("value")) for d, c in dims.items()])).alias("x")
    counts = (
        binned.select(*keys, "score", "alpha", "score_date", pairs)
        .select(*keys, "score", "alpha", "score_date", "x.*").filter(F.col("value").isNotNull())
        .groupBy(*keys, "dim", "value").agg(
            F.count("*").alias("cnt"), F.avg("score").alias("score"), F.avg("alpha").alias("alpha"),
            F.avg(F.when(F.col("alpha") > 0, 1.0).otherwise(0.0)).alias("beat"),
            F.min("score_date").alias("first_date"), F.max("score_date").alias("last_date"))
    )
    # only sectors and regimes are ranked; every other value stands alone
    alone = F.when(~F.col("dim").isin("sector", "regime"), F.col("value"))
    ranked = top_counts(counts.withColumn("alone", alone), [*keys, "dim", "alone"], "value")
    of = lambda c: F.max(F.when(F.col("dim") == "all", F.col(c)))

    def listed(chosen: Column) -> Column:
        """The labels of the chosen rows in order of rank; NULL without any."""
        both = F.array_sort(F.collect_list(F.when(chosen, F.struct("rank", "label"))))
        return F.nullif(F.concat_ws(", ", F.transform(both, lambda x: x["label"])), F.lit(""))

    rows = ranked.groupBy(*keys).agg(
        of("cnt").alias("n"), rnd(of("score"), 4).alias("avg_score"), rnd(of("alpha"), 2).alias("avg_alpha"),
        rnd(of("beat"), 4).alias("beat_spy_pct"), of("first_date").alias("first_date"), of("last_date").alias("last_date"),
        F.count_if(F.col("dim") == "date").alias("n_unique_dates"), F.count_if(F.col("dim") == "symbol").alias("n_unique_tickers"),
        listed((F.col("dim") == "sector") & (F.col("rank") <= 3)).alias("top_sectors"),
        listed(F.col("dim") == "regime").alias("regime_breakdown"),
    ).filter(F.col("n") >= min_per_bucket)
    everything = Window.partitionBy(F.lit(0))  # n_buckets rows
    falls = F.col("avg_alpha") < F.lag("avg_alpha").over(everything.orderBy("bin"))
    total = F.sum("n").over(everything)
    return (
        rows.withColumn("__falls", F.coalesce(falls, F.lit(False)))
        .withColumn("monotonic", ~F.max("__falls").over(everything))
        .withColumn("__ok", (total >= n_buckets * min_per_bucket) & (F.count("*").over(everything) >= 2))
        .filter("__ok")
        .drop("__falls", "__ok")
    )


def top_counts(counts: DataFrame, groups: list[str], col: str) -> DataFrame:
    """Values per group by frequency as ``rank:value=count``; ties by name."""
    order = Window.partitionBy(*groups).orderBy(F.col("cnt").desc(), col)
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .withColumn("label", F.concat(F.col("rank").cast("string"), F.lit(":"), F.col(col), F.lit("="),
                                      F.col("cnt").cast("string")))
    )


def sub_score_columns(df: DataFrame) -> dict[str, Column]:
    """Explicit quant_score / qual_score columns, else the fields of a sub_scores struct."""
    explicit = {n: F.col(f"{n}_score") for n in ("quant", "qual") if f"{n}_score" in df.columns}
    if explicit or "sub_scores" not in df.columns:
        return explicit
    fields = df.schema["sub_scores"].dataType.fieldNames()
    return {n: F.col(f"sub_scores.{n}") for n in ("quant", "qual") if n in fields}


def sub_score_attribution(signals: DataFrame, min_rows: int = 100, p_values: bool = True) -> DataFrame:
    """Pearson r of each sub-score and of the predictor against the outcomes.

    One scan computes every correlation; the small result row is then turned
    into one row per (source, target), tested and ranked.
    """
    resolved = signals.filter(F.col("beat_spy_10d").isNotNull())
    sources = dict(sub_score_columns(resolved))
    pairs = [(s, t, c) for s, c in sources.items()
             for t in ("beat_spy_10d", "beat_spy_30d", "return_10d", "return_30d")]
    if {"p_up", "p_down"} <= set(signals.columns):
        net = net_signal("p_up", "p_down")
        pairs += [("predictor", t, net) for t in ("beat_spy_10d", "beat_spy_30d")]
    aggs = [F.count("*").alias("rows_analyzed")]
    for s, t, c in pairs:
        both = c.isNotNull() & F.col(t).isNotNull()
        aggs += [rnd(pearson(c, t, 10), 6).alias(f"r__{s}__{t}"), F.count_if(both).alias(f"n__{s}__{t}")]
    wide = resolved.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(s).alias("source"), F.lit(t).alias("target"),
                 F.col(f"r__{s}__{t}").alias("r"), F.col(f"n__{s}__{t}").alias("n"))
        for s, t, _ in pairs
    ])).alias("x")
    long = wide.select("rows_analyzed", rows).select("rows_analyzed", "x.*") \
        .filter(F.col("rows_analyzed") >= min_rows)
    order = Window.partitionBy("target").orderBy(F.coalesce("r", F.lit(0.0)).desc(), "source")
    ranked = long.withColumn("rank", F.when(F.col("source") != "predictor", F.row_number().over(
        Window.partitionBy("target", F.col("source") == "predictor")
        .orderBy(F.coalesce("r", F.lit(0.0)).desc(), "source"))))
    if not p_values:
        return ranked
    tested = ranked.withColumn("p_value", rnd(pearson_p_value("r", "n"), 4))
    return benjamini_hochberg(tested, "p_value", "fdr_significant")


def predictor_hit_rate(signals: DataFrame, min_rows: int = 10) -> DataFrame:
    resolved = signals.filter(F.col("beat_spy_10d").isNotNull())
    correct = F.col("correct_5d").try_cast("double")
    lo, hi = wilson_bounds(F.coalesce(F.sum(correct), F.lit(0.0)), F.count(correct))
    row = resolved.agg(F.count(correct).alias("n"), rnd(F.avg(correct), 4).alias("hit_rate"),
                       lo.alias("ci_low"), hi.alias("ci_high"))
    enough = F.col("n") >= min_rows
    return row.select("n", *[F.when(enough, F.col(c)).alias(c) for c in ("hit_rate", "ci_low", "ci_high")])


def accumulation(signals: DataFrame) -> DataFrame:
    """How much data there is: rows, resolved per horizon, dates, first and last day, accuracy."""
    aggs = [F.count("*").alias("total_rows"), F.min("score_date").alias("first_date"),
            F.max("score_date").alias("last_date")]
    for h in HORIZONS:
        beat = F.col(f"beat_spy_{h}")
        aggs += [F.count(beat).alias(f"resolved_{h}"), rnd(F.avg(beat), 4).alias(f"accuracy_{h}")]
    totals = signals.agg(*aggs)
    dates = signals.select("score_date").distinct().agg(F.count("score_date").alias("distinct_dates"))
    return with_scalars(totals, dates)


def stale_rows(signals: DataFrame, asof, date_col: str = "score_date",
               limits: dict[str, int] | None = None) -> DataFrame:
    """Unresolved rows older than the days their horizon needs; ``asof`` is explicit."""
    limits = limits or {"5d": 10, "10d": 14, "30d": 45}
    day = F.lit(asof).cast("date") if isinstance(asof, str) else asof
    return signals.agg(*[
        F.count_if(F.col(f"return_{h}").isNull() & (F.col(date_col) <= F.date_sub(day, n)))
        .alias(f"stale_{h}") for h, n in limits.items()
    ])


