"""Attaching one-row results to a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalars(df: DataFrame, *rows: DataFrame) -> DataFrame:
    """Add the columns of one-row tables as scalar subqueries.

    No join is planned: Spark runs each subquery once and hands its value to the
    tasks.  A table of more than one row is an error, an empty one gives NULLs.
    """

    def add(left: DataFrame, row: DataFrame) -> DataFrame:
        value = row.select(F.struct(*row.columns).alias("v")).scalar()
        return left.withColumns({c: value[c] for c in row.columns})

    return reduce(add, rows, df)


def with_status(counts: DataFrame, result: DataFrame, least: int, n: str = "n") -> DataFrame:
    """One row whatever a sample gate says: ``status`` and ``n``, and the columns of the gated result or NULLs.

    ``counts`` is the one row that the gate looks at, ``result`` the one row behind it, or none where the gate refused.
    """
    spine = counts.select(
        F.when(F.col(n) >= least, "ok").otherwise("insufficient_data").alias("status"), F.col(n).alias("n_samples"))
    return with_scalars(spine, result.select(*[c for c in result.columns if c not in ("status", "n_samples")]))
