"""Tables that are written once: from small partitions, and with no more columns shuffled than are read."""

import pytest
from pyspark.sql import functions as F

from assay.plans import views as V

SF = "/root/testdata/sf0.001"
CONF = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes")


class WithFolder:
    """The session as it is where ``spark.checkpoint.dir`` was set at its start."""

    def __init__(self, inner, folder=None):
        self._inner, self._folder = inner, folder

    def __getattr__(self, name):
        value = getattr(self._inner, name)
        return WithFolder(value, self._folder) if name == "conf" else value

    def get(self, key, *default):
        return self._folder if key == "spark.checkpoint.dir" else self._inner.get(key, *default)


@pytest.fixture
def tables(spark, tmp_path):
    return V.Tables(WithFolder(spark, str(tmp_path)), SF)


def test_kept_tables_start_from_many_partitions(spark, tables):
    before = [spark.conf.get(k, None) for k in CONF]
    plans = []

    def build():
        df = spark.range(100).repartition("id").groupBy((F.col("id") % 7).alias("k")).count()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    got = tables.kept("many_parts", build)
    assert got.count() == 7
    assert "hashpartitioning(id" in plans[0] and plans[0].count(f", {V.WRITE_PARTS})") == 2
    assert [spark.conf.get(k, None) for k in CONF] == before


def test_settings_return_where_a_write_fails(spark, tables):
    before = [spark.conf.get(k, None) for k in CONF]
    with pytest.raises(Exception):
        tables.kept("fails", lambda: spark.range(3).select(F.raise_error(F.lit("no")).alias("x")))
    assert [spark.conf.get(k, None) for k in CONF] == before


def test_cells_that_are_not_entered_carry_day_and_price_alone(spark):
    t = V.Tables(spark, SF)
    table, deal = V.DEALT["round_trips"]
    cells, dealt = getattr(t, table), deal(getattr(t, table))
    total = V._TOTAL.replace("c.", "")
    entered = cells.filter(f"{total} >= 75").count()
    assert 0 < entered < cells.count() and dealt.count() == cells.count()
    assert dealt.filter("okey is not null").count() == entered == dealt.filter(f"{total} >= 75").count()
    cells.createOrReplaceTempView("whole_cells")
    plain = spark.sql(V._fill(V.VIEWS["round_trips"], {"cells": "whole_cells"}))
    got = t._view("round_trips")
    assert got.columns == plain.columns and got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
