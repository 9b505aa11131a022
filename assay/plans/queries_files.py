"""Tables written as files and read back, with their SQL oracles."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from assay.functions.scalars import rnd
from assay.plans.registry import query
from assay.plans.views import r
from assay.sources import tables as TB


def folder(t) -> str:
    """A new folder below the shared one; in a session that runs in one process and names none, a temporary one."""
    shared = t.spark.conf.get("spark.checkpoint.dir", None)
    master = t.spark.sparkContext.master
    if not shared and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='assay-')).rstrip('/')}/assay-files/{uuid.uuid4().hex}"


@query("table_round_trip", "SELECT ticker, CAST(eval_date AS VARCHAR) AS eval_date, sector, return_5d, beat_spy_5d FROM {universe_returns}")
def _(t):
    """A table as Parquet and back; columns that a reader relies on are asked for by name."""
    path = folder(t)
    TB.write_table(t.universe_returns, path)
    return TB.read_table(t.spark, path, ["ticker", "eval_date", "return_5d"]).select("ticker", "eval_date", "sector", "return_5d", "beat_spy_5d")


@query("series_round_trip", f"""SELECT ticker, count(*) AS n_bars, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date, {r('sum(close)', 3)} AS total_close,
  max(high) AS top FROM {{bars}} GROUP BY ticker""")
def _(t):
    """All series of bars in one table, stored in ranges of tickers, so that one series touches few files."""
    path = folder(t)
    TB.write_table(t.bars, path, cluster="ticker")
    return TB.read_table(t.spark, path, ["ticker", "date", "close"]).groupBy("ticker").agg(
        F.count("*").alias("n_bars"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        rnd(F.sum("close"), 3).alias("total_close"), F.max("high").alias("top"))


@query("result_file_round_trip", "SELECT * FROM {sweep_combos}")
def _(t):
    """A small result table as one CSV file for other readers, read back by its schema."""
    path, rows = folder(t), t.sweep_combos
    TB.export_result(rows, path)
    return t.spark.read.schema(rows.schema).option("header", True).csv(path)


_RUNS = ["2001-08-01", "2001-08-08"]


@query("run_export_round_trip", " UNION ALL ".join(
    f"SELECT '{d}' AS run_date, 'combos' AS name, count(*) AS n, {r('sum(min_score)', 3)} AS total FROM {{sweep_combos}} "
    f"UNION ALL SELECT '{d}', 'shadow', count(*), {r('sum(research_score)', 3)} FROM {{shadow_book}}" for d in _RUNS))
def _(t):
    """The tables of two runs, a folder per table and a partition per run; the second run is exported twice."""
    root, tables = folder(t), {"combos": t.sweep_combos, "shadow": t.shadow_book}
    for d in [*_RUNS, _RUNS[-1]]:
        TB.export_run(tables, root, d)
    parts = [TB.read_table(t.spark, f"{root}/{name}", ["run_date", c]).groupBy(F.col("run_date").cast("string").alias("run_date")).agg(
        F.lit(name).alias("name"), F.count("*").alias("n"), rnd(F.sum(c), 3).alias("total"))
        for name, c in (("combos", "min_score"), ("shadow", "research_score"))]
    return parts[0].unionByName(parts[1])
