"""Multiple-test correction and the Pearson p-value, over result tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def benjamini_hochberg(df: DataFrame, p: str, out: str, alpha: float = 0.05,
                       groups: list[str] | None = None) -> DataFrame:
    """Flag the tests that survive the step-up procedure.

    Input is a result table (one row per test), never raw data, so the window
    over all tests is small.  NULL p-values are not tests and are never flagged.
    """
    keys = groups or [F.lit(0)]
    tested = F.col(p).isNotNull()
    ranked = df.withColumns({
        "__k": F.when(tested, F.row_number().over(
            Window.partitionBy(*keys).orderBy(F.col(p).asc_nulls_last()))),
        "__m": F.count(p).over(Window.partitionBy(*keys)),
    })
    passing = F.when(F.col(p) <= F.col("__k") / F.col("__m") * alpha, F.col("__k"))
    return ranked.withColumn("__max", F.max(passing).over(Window.partitionBy(*keys))).withColumn(
        out, F.coalesce(F.col("__k") <= F.col("__max"), F.lit(False))
    ).drop("__k", "__m", "__max")


#: Intervals of the integrals below; their error is far below the four digits that p-values are rounded to.
STEPS = 200


def _cosine_integral(power: Column, low: Column, high: Column) -> Column:
    """Integral of cos(x) ** power from low to high, by Simpson's rule over a fixed range of nodes."""
    h = (high - low) / STEPS
    weight = lambda k: F.when((k == 0) | (k == STEPS), 1.0).when(k % 2 == 1, 4.0).otherwise(2.0)
    node = lambda k: F.pow(F.greatest(F.cos(low + k * h), F.lit(0.0)), power)
    return F.aggregate(F.sequence(F.lit(0), F.lit(STEPS)), F.lit(0.0), lambda s, k: s + weight(k) * node(k)) * h / 3


def pearson_p_value(r: str, n: str) -> Column:
    """Two-sided p of a correlation (Student t with n - 2 degrees of freedom), as a column expression.

    With x = asin|r| the density of the t statistic becomes cos(x) ** (n - 3), so p is the share of its integral beyond
    x; no gamma function is needed. Where n is large the integrand has vanished long before a right angle, and both
    integrals stop there. NULL below three rows or without a correlation, 0 for a perfect one.
    """
    rr, nn = F.col(r).cast("double"), F.col(n).cast("double")
    df, x = nn - 2, F.asin(F.least(F.abs(rr), F.lit(1.0)))
    right = F.lit(math.pi / 2)
    whole = _cosine_integral(df - 1, F.lit(0.0), F.least(right, F.sqrt(60.0 / df)))
    tail = _cosine_integral(df - 1, x, F.least(right, F.sqrt(x * x + 60.0 / df)))
    known = rr.isNotNull() & ~F.isnan(rr) & nn.isNotNull() & ~F.isnan(nn) & (nn >= 3)
    return F.when(known, F.when(F.abs(rr) >= 1, 0.0).otherwise(F.least(F.lit(1.0), tail / whole)))
