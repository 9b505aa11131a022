"""Aggregate expressions: all algebraic, so Spark combines them map-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assay.functions.scalars import _c, ratio, rnd

FLAT = 1e-9


def count_where(cond) -> Column:
    return F.count_if(cond)


def share_where(cond, of) -> Column:
    """Share of the rows with a non-NULL ``of`` on which ``cond`` holds."""
    return F.avg(F.when(_c(of).isNotNull(), F.when(cond, 1.0).otherwise(0.0)))


def pearson(x, y, least_rows: int = 2) -> Column:
    """Pearson r over complete pairs; NULL below ``least_rows`` or for a flat side.

    The builtin ``corr`` raises a division error on a flat column in ANSI mode.
    """
    x, y = _c(x).cast("double"), _c(y).cast("double")
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    sx, sy = F.stddev_samp(px), F.stddev_samp(py)
    return F.when(
        (F.count(px) >= least_rows) & (sx > FLAT) & (sy > FLAT),
        F.try_divide(F.covar_samp(px, py), sx * sy),
    )


def sample_skewness(x) -> Column:
    """Bias-corrected skewness; Spark's builtin is the population form."""
    n = F.count(x).cast("double")
    return F.when(
        (n >= 3) & (F.stddev_samp(x) > FLAT),
        F.skewness(x) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)),
    )


def null_safe_mean(c, digits: int = 4) -> Column:
    return rnd(F.avg(c), digits)


def win_rate(alpha, digits: int = 4) -> Column:
    return rnd(share_where(_c(alpha) > 0, alpha), digits)


def weighted_average(weight, grade) -> Column:
    """Weighted mean that skips NULL grades in both sums."""
    g, w = _c(grade), _c(weight)
    return F.try_divide(F.sum(w * g), F.sum(F.when(g.isNotNull(), w)))


def binary_counts(selected, positive) -> dict[str, Column]:
    """tp / fp / fn / tn over rows whose outcome is known."""
    s, p = _c(selected), _c(positive)
    known = p.isNotNull()
    return {
        "tp": F.count_if(known & s & p),
        "fp": F.count_if(known & s & ~p),
        "fn": F.count_if(known & ~s & p),
        "tn": F.count_if(known & ~s & ~p),
    }


def binary_metrics(df, prefix: str = ""):
    """Add precision, recall, f1, accuracy to a table that carries the four counts."""
    tp, fp, fn, tn = (F.col(prefix + n) for n in ("tp", "fp", "fn", "tn"))
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    f1 = F.try_divide(2 * precision * recall, precision + recall)
    return df.withColumns({
        prefix + "precision": rnd(precision, 4),
        prefix + "recall": rnd(recall, 4),
        prefix + "f1": rnd(f1, 4),
        prefix + "accuracy": rnd(ratio(tp + tn, tp + fp + fn + tn), 4),
        prefix + "n": tp + fp + fn + tn,
    })
