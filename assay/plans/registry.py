"""Registry of runnable queries: a Spark plan and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.plans.views import BASE, VIEWS, Tables, oracle_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text, so every engine hands out the same values."""
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
        for f in df.schema.fields
    ])


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register ``build(tables) -> DataFrame``; ``{view}`` in ``sql`` names a table."""

    def register(build: Callable[[Tables], DataFrame]):
        assert name not in QUERIES, name

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(Tables(spark, sf_dir)))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            text, used = sql, []
            for n in list(VIEWS) + BASE:
                if "{" + n + "}" in text:
                    used.append(n)
                    text = text.replace("{" + n + "}", n)
            prefix = oracle_ctes(used)
            body = text.strip()
            if body.upper().startswith("WITH "):
                ORACLES[name] = f"WITH {prefix},\n{body[5:]}" if prefix else body
            else:
                ORACLES[name] = f"WITH {prefix}\n{body}" if prefix else body
        return build

    return register
