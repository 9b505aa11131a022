"""Tables: scans, shape unification, upserts and writes.

Writes go to a folder the caller names; dated results use dynamic partition
overwrite, so a rerun of a date replaces that date only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.sources.schemas import TRADES, conform


def scan_or_empty(spark: SparkSession, table: str, ddl: str) -> DataFrame:
    """A catalog table in the given shape; an absent table is an empty one."""
    if spark.catalog.tableExists(table):
        return conform(spark.table(table), ddl)
    return spark.createDataFrame([], T.StructType.fromDDL(ddl))


def trades_since(trades: DataFrame, since=None) -> DataFrame:
    d = conform(trades, TRADES)
    return d if since is None else d.filter(F.col("date") >= F.lit(since).cast("date"))


def jdbc_scan(spark: SparkSession, url: str, table: str, column: str, lower, upper, parts: int, **options) -> DataFrame:
    """A database table read in ``parts`` ranges of one column, one task each."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=column, lowerBound=str(lower), upperBound=str(upper),
        numPartitions=str(parts), **options).load()


def unify(frames: list[DataFrame]) -> DataFrame:
    """Stack frames whose columns differ: first-seen column order, absent columns
    NULL, numeric types that differ become double, any other difference is an error."""
    order: list[str] = []
    types: dict[str, list[T.DataType]] = {}
    for f in frames:
        for c in f.schema.fields:
            if c.name not in types:
                order.append(c.name)
            types.setdefault(c.name, []).append(c.dataType)
    widen = set()
    for name, seen in types.items():
        if len({t.simpleString() for t in seen}) > 1:
            if not all(isinstance(t, T.NumericType) for t in seen):
                raise TypeError(f"column {name} has incompatible types {[t.simpleString() for t in seen]}")
            widen.add(name)
    cast = [f.withColumns({c: F.col(c).cast("double") for c in f.columns if c in widen}) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast).select(*order)


def stack_series(wide: DataFrame, key: str, value: str = "value") -> DataFrame:
    """One column per ticker to (ticker, key, value)."""
    names = [c for c in wide.columns if c != key]
    return wide.unpivot(key, names, "ticker", value).filter(F.col(value).isNotNull())


def series_of(stacked: DataFrame, ticker: str) -> DataFrame:
    return stacked.filter(F.col("ticker") == ticker)


def write_table(df: DataFrame, path: str, by: list[str] | None = None, cluster: str | None = None,
                mode: str = "overwrite") -> None:
    """Parquet; ``cluster`` sorts by range, so that a filter on it skips files."""
    if cluster:
        df = df.repartitionByRange(cluster).sortWithinPartitions(cluster)
    w = df.write.mode(mode)
    if by:
        w = w.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def read_table(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    missing = [c for c in (required or []) if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    return df


def upsert_by_date(history: DataFrame, rows: DataFrame, date_col: str = "date", keep: int | None = 52) -> DataFrame:
    """Rows of a date replace the stored ones; only the ``keep`` latest dates stay."""
    old = history.join(rows.select(date_col).distinct(), date_col, "left_anti")
    merged = old.unionByName(rows, allowMissingColumns=True)
    if keep is None:
        return merged
    latest = merged.select(date_col).distinct().orderBy(F.col(date_col).desc()).limit(keep)
    return merged.join(latest, date_col, "left_semi")


def append_once(history: DataFrame, row: DataFrame, key: str = "run_date") -> DataFrame:
    """Idempotent append with new columns allowed, in key order."""
    return upsert_by_date(history, row, key, keep=None).orderBy(key)


def latest_row(history: DataFrame, order: str) -> DataFrame:
    rest = [c for c in history.columns]
    return history.agg(F.max_by(F.struct(*rest), order).alias("r")).filter(F.col("r").isNotNull()).select("r.*")


def export_result(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """A small result table as one file for readers outside Spark."""
    w = df.coalesce(1).write.mode("overwrite")
    w.option("header", True).csv(path) if fmt == "csv" else w.json(path)


def export_run(tables: dict[str, DataFrame], root: str, run_date: str) -> None:
    """One folder per table, one partition per run date."""
    for name, df in tables.items():
        write_table(df.withColumn("run_date", F.lit(run_date)), f"{root}/{name}", by=["run_date"])


def as_json(df: DataFrame, key: str) -> DataFrame:
    """(key, document): every other column packed into one JSON text."""
    return df.select(key, F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("document"))


def from_json_rows(docs: DataFrame, key: str, ddl: str) -> DataFrame:
    return docs.select(key, F.from_json("document", ddl).alias("d")).select(key, "d.*")


def nth_latest(df: DataFrame, by: str, order: str, n: int) -> DataFrame:
    """The n latest rows per group, limited map-side before the shuffle."""
    w = Window.partitionBy(by).orderBy(F.col(order).desc())
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n).drop("__r")
