"""The two sizing runs hold every trade on every held day: against the plain path from an order log."""

from pyspark.sql import functions as F

from assay.operators import portfolio as PF
from assay.operators.asof import calendar
from assay.plans import queries_recommend as QR
from assay.plans.views import Tables


def test_sizing_runs_are_whole_portfolio_runs(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    cal, trades = calendar(t.market_state), t.trades
    mean = round(trades.filter("action = 'ENTER'").agg(F.avg("position_pct")).first()[0], 6)
    both = trades.withColumn("combo_id", F.lit("sized")).withColumn("pct", F.col("position_pct")).unionByName(
        trades.withColumn("combo_id", F.lit("equal")).withColumn("pct", F.lit(mean)))
    shares = F.expr("double(CASE WHEN action = 'REDUCE' THEN floor(shares * pct * 10 / 2) ELSE floor(shares * pct * 20) END)")
    log = both.select("combo_id", F.col("trade_id").alias("seq"), "date", "ticker", "action", shares.alias("shares"), F.col("fill_price").alias("price"))
    nav = PF.nav_history(PF.executed_orders(log), cal, t.market_state)
    spy = PF.benchmark_return(t.market_state.filter("ticker = 'S0'").select("date", "close"), cal.select("date"))
    runs = spark.createDataFrame([("sized",), ("equal",)], "combo_id string")
    expected = {r.combo_id: r.asDict() for r in PF.combo_statistics(runs, nav, log, spy).collect()}
    found = {r.combo_id: r.asDict() for r in QR.sizing_runs(t).collect()}
    assert found.keys() == expected.keys() == {"sized", "equal"}
    for k, row in expected.items():
        assert row["total_orders"] == trades.count() and row["status"] == "ok"
        for c, v in row.items():
            assert found[k][c] == v or abs(found[k][c] - v) < 2e-6, (k, c)
