import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assay.operators import asof as A
from assay.operators import indicators as I
from assay.operators import prices as P
from tests.conftest import rows


def test_asof_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    days = pd.date_range("2024-01-01", periods=60)
    left = pd.DataFrame({"k": rng.choice(["a", "b", "c"], 300), "d": rng.choice(days, 300), "i": range(300)})
    right = pd.DataFrame({"k": rng.choice(["a", "b"], 40), "d": rng.choice(days[5:], 40), "v": rng.normal(size=40)})
    right = right.drop_duplicates(["k", "d"])
    ldf = spark.createDataFrame(left).withColumn("d", F.to_date("d"))
    rdf = spark.createDataFrame(right).withColumn("d", F.to_date("d"))
    got = {r["i"]: r["v"] for r in A.asof_backward(ldf, rdf, ["k"], "d", "d", ["v"]).collect()}
    assert len(got) == 300
    for r in left.itertuples():
        prior = right[(right.k == r.k) & (right.d <= r.d)].sort_values("d")
        assert got[r.i] == (prior.v.iloc[-1] if len(prior) else None)


def test_asof_keeps_null_payload_and_duplicates(table):
    left = table("k string, d date", [("a", "2024-01-05"), ("a", "2024-01-05"), ("z", "2024-01-05")])
    right = table("k string, d date, v double, s int", [("a", "2024-01-01", 1, 1), ("a", "2024-01-03", None, 1), ("a", "2024-01-03", None, 2)])
    got = A.asof_backward(left, right, ["k"], "d", "d", ["v"], tie="s")
    assert got.filter("k = 'a'").count() == 2
    assert {str(r["matched_date"]) for r in got.filter("k = 'a'").collect()} == {"2024-01-03"}
    assert got.filter("k = 'z' AND matched_date IS NULL").count() == 1


def test_interval_extremes_across_months(spark):
    rng = np.random.default_rng(4)
    days = pd.bdate_range("2023-11-01", "2024-06-30")
    bars = pd.DataFrame([(t, d, h, h - rng.random()) for t in "ab" for d in days for h in [rng.normal() * 5 + 100]],
                        columns=["ticker", "date", "high", "low"])
    trips = pd.DataFrame([(i, str(rng.choice(["a", "b", "q"])), *sorted(rng.choice(days, 2))) for i in range(80)],
                         columns=["id", "ticker", "en", "ex"])
    b = spark.createDataFrame(bars).withColumn("date", F.to_date("date"))
    t = spark.createDataFrame(trips).withColumn("en", F.to_date("en")).withColumn("ex", F.to_date("ex"))
    got = {r["id"]: r for r in A.interval_extremes(t, b, "id", "en", "ex").collect()}
    for r in trips.itertuples():
        part = bars[(bars.ticker == r.ticker) & (bars.date >= r.en) & (bars.date <= r.ex)]
        if part.empty:
            assert r.id not in got
        else:
            assert (got[r.id]["max_high"], got[r.id]["min_low"], got[r.id]["n_bars"]) == (part.high.max(), part.low.min(), len(part))


def test_vwap_lookback_counts_rows_before_dropping(table):
    f = table("ticker string, date date, vwap double", [
        ("a", "2024-01-01", 5), ("a", "2024-01-02", None), ("a", "2024-01-03", -1), ("a", "2024-01-04", 0), ("a", "2024-01-05", None),
        ("a", "2024-01-08", None)])
    asked = table("ticker string, date date", [("a", "2024-01-06"), ("a", "2024-01-09"), ("a", "2023-12-31")])
    assert rows(A.vwap_for_dates(f, asked).select(F.col("date").cast("string"), "vwap_used")) == [
        ("2023-12-31", None), ("2024-01-06", 5.0), ("2024-01-09", None)]


def test_calendar_moves(table):
    cal = A.calendar(table("date date", [("2024-01-02",), ("2024-01-03",), ("2024-01-05",)]))
    nxt = A.next_trading_day(table("date date", [("2024-01-01",), ("2024-01-03",), ("2024-01-04",), ("2024-01-06",)]), cal)
    assert rows(nxt.select(F.col("date").cast("string"), F.col("trading_date").cast("string"))) == [
        ("2024-01-01", "2024-01-02"), ("2024-01-03", "2024-01-03"), ("2024-01-04", "2024-01-05"), ("2024-01-06", None)]
    orders = table("date date, action string, i int", [("2024-01-03", "ENTER", 1), ("2024-01-05", "ENTER", 2), ("2024-01-05", "EXIT", 3)])
    assert rows(A.shift_entries_to_next_day(orders, cal).select("i", F.col("fill_date").cast("string"))) == [
        (1, "2024-01-05"), (3, "2024-01-05")]
    sig = table("date date, bucket string", [("2024-01-02", "buy"), ("2024-01-02", "universe")])
    assert rows(A.carry_signals(sig, cal).select(F.col("date").cast("string"), "bucket")) == [
        ("2024-01-02", "buy"), ("2024-01-02", "universe"), ("2024-01-03", "universe"), ("2024-01-05", "universe")]


def bars_with_gaps(spark, n=40, seed=8):
    rng = np.random.default_rng(seed)
    days = pd.bdate_range("2024-01-01", periods=n)
    wide = pd.DataFrame({t: rng.normal(100, 5, n) for t in ("a", "b", "c", "d")}, index=days)
    wide.loc[rng.random(n) < 0.3, "a"] = np.nan
    wide.iloc[5:20, 1] = np.nan   # long inner gap
    wide.iloc[30:, 2] = np.nan    # long tail
    wide.iloc[:9, 3] = np.nan     # late start
    wide.iloc[-3, 0] = 100.0
    long = wide.rename_axis("date").reset_index().melt("date", var_name="ticker", value_name="close").dropna()
    return wide, days, spark.createDataFrame(long).withColumn("date", F.to_date("date"))


@pytest.mark.parametrize("backfill", [True, False])
def test_price_matrix_matches_pandas(spark, backfill):
    wide, days, df = bars_with_gaps(spark)
    cal = A.calendar(spark.createDataFrame([(d.date(),) for d in days], "date date"))
    want = wide.ffill(limit=5)
    want = want.bfill() if backfill else want
    got = P.price_matrix(df, cal, 5, backfill).toPandas().pivot(index="date", columns="ticker", values="price")
    got.index = pd.to_datetime(got.index)
    pd.testing.assert_frame_equal(got.reindex(days), want, check_names=False, check_freq=False)
    gaps = P.gap_statistics(df, cal, 5, backfill).toPandas().set_index("ticker")
    assert gaps["n_missing"].to_dict() == wide.isna().sum().to_dict()
    assert gaps["n_unfilled"].to_dict() == want.isna().sum().to_dict()
    assert gaps["dropped"].to_dict() == (want.isna().sum() > 0).to_dict()


def test_keep_last_and_universe(table):
    t = table("ticker string, date date, close double, f1 double, ord int", [
        ("a", "2024-01-01", 1, 9, 1), ("a", "2024-01-01", 2, 8, 2), ("b", "2024-01-01", 3, 7, 1), ("SPY", "2024-01-01", 4, 0, 1)])
    macro = table("ticker string, date date, close double, ord int", [("SPY", "2024-01-01", 99, 1), ("VIX", "2024-01-01", 5, 1), ("zzz", "2024-01-01", 5, 1)])
    prices, feats = P.load_universe(t, macro, "ord", table("ticker string", [("a",)]))
    assert rows(prices.select("ticker", "close")) == [("SPY", 4.0), ("VIX", 5.0), ("a", 2.0)]
    assert rows(feats.select("ticker", "close", "f1")) == [("a", 2.0, 8.0)]


def test_read_gate(table):
    have = table("ticker string, date date", [("a", "2024-01-01")])
    bad = P.read_quality(table("ticker string", [("a",), ("b",)]), have)
    assert rows(bad.select("n_missing", "error_rate", "status")) == [(1, 0.5, "failed")]
    assert P.read_quality(table("ticker string", []), have).first()["status"] == "empty_universe"
    with pytest.raises(Exception, match="price read gate"):
        P.require_quality(have, bad).collect()
    ok = P.read_quality(table("ticker string", [("a",)]), have)
    assert P.require_quality(have, ok).count() == 1


def test_staleness_in_business_days(table):
    bar = lambda d: table("ticker string, date date", [("a", d)])
    tier = lambda d, asof: P.staleness_tier(bar(d), asof).first()["tier"]
    # Monday 2024-02-05: two business days back is Thursday, five is Monday of last week
    assert (tier("2024-02-01", "2024-02-05"), tier("2024-01-31", "2024-02-05"), tier("2024-01-26", "2024-02-05")) == ("ok", "warn", "break")
    assert tier("2024-02-01", "2024-02-04") == "ok"


def test_ohlc_defaults(table):
    d = P.normalise_ohlc(table("ticker string, date date, Close double, HIGH double, ord int", [
        ("a", "2024-01-01", 1, 3, 1), ("a", "2024-01-01", 2, None, 2), ("b", "2024-01-01", None, 1, 1)]), "ord")
    assert rows(d.select("ticker", "open", "high", "low", "close")) == [("a", 2.0, 2.0, 2.0, 2.0)]


def close_series(spark, n=260, seed=2):
    rng = np.random.default_rng(seed)
    c = 100 + np.cumsum(rng.normal(size=n))
    days = pd.bdate_range("2022-01-03", periods=n)
    pdf = pd.DataFrame({"ticker": "a", "date": days, "close": c})
    return pdf, spark.createDataFrame(pdf).withColumn("date", F.to_date("date"))


def test_indicators_match_pandas(spark):
    pdf, df = close_series(spark)
    got = I.indicator_series(df).orderBy("date").toPandas()
    c = pdf["close"]
    move = c.diff()
    up, down = move.clip(lower=0).ewm(com=13, adjust=False).mean(), (-move.clip(upper=0)).ewm(com=13, adjust=False).mean()
    np.testing.assert_allclose(got["rsi_14"].astype(float), 100 - 100 / (1 + up / down.replace(0, np.nan)), rtol=1e-9)
    np.testing.assert_allclose(got["price_vs_ma50"].astype(float), (c / c.rolling(50).mean() - 1) * 100, rtol=1e-9)
    np.testing.assert_allclose(got["momentum_20d"].astype(float), (c / c.shift(20) - 1) * 100, rtol=1e-9)
    assert got["price_vs_ma200"].isna().sum() == 199 and got["rsi_14"].isna().iloc[0]
    held = got["macd_cross"].to_numpy()
    starts = [i for i in range(1, len(held)) if held[i] != 0 and held[i] != held[i - 1]]
    assert starts and all((held[i:i + 3] != 0).all() for i in starts if i + 3 <= len(held))


def test_indicators_shuffle_once(spark):
    _, df = close_series(spark, 30)
    plan = I.indicator_series(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_signals_cap_and_percentile(spark, table):
    df = table("date date, ticker string, momentum_20d double", [
        ("2024-01-01", "a", 1), ("2024-01-01", "b", 3), ("2024-01-01", "c", None), ("2024-01-01", "d", 3)])
    assert rows(I.with_momentum_percentile(df).select("ticker", "momentum_percentile")) == [
        ("a", 0.0), ("b", 50.0), ("c", 50.0), ("d", 100.0)]
    scored = table("date date, ticker string, score double, signal string", [
        ("2024-01-01", t, s, "ENTER" if s >= 60 else "HOLD") for t, s in (("a", 90), ("b", 80), ("c", 80), ("d", 10))])
    got = rows(I.cap_entries(scored, 2).select("ticker", "signal", "rating", "bucket"))
    assert got == [("a", "ENTER", "BUY", "buy"), ("b", "ENTER", "BUY", "buy"), ("c", "HOLD", "HOLD", "universe"), ("d", "HOLD", "HOLD", "universe")]


def test_zeroed_feature_readmits_a_row(table):
    f = table("ticker string, date date, x double, y double", [
        ("a", "2024-01-01", 1, None), ("b", "2024-01-01", 1, float("nan")), ("c", "2024-01-01", 1, 2), ("d", "2024-01-01", None, 2)])
    assert rows(I.scoreable_rows(f, ["x", "y"]).select("ticker")) == [("c",)]
    got = I.linear_scores(I.scoreable_rows(f, ["x", "y"], zero=["y"]), {"x": 2.0, "y": 5.0}, 1.0)
    assert rows(got.select("ticker", "alpha")) == [("a", 3.0), ("b", 3.0), ("c", 3.0)]


def test_smoothed_means_over_many_blocks(spark):
    """Several tickers, blocks that end at and beside the last bar, and a mean that starts at the second bar."""
    rng = np.random.default_rng(4)
    frames = []
    for ticker, n in (("a", 1), ("b", 63), ("c", 64), ("d", 65), ("e", 700)):
        frames.append(pd.DataFrame({"ticker": ticker, "date": pd.bdate_range("2020-01-01", periods=n), "bar_no": range(1, n + 1), "x": rng.normal(size=n)}))
    pdf = pd.concat(frames)
    df = spark.createDataFrame(pdf).withColumn("date", F.to_date("date"))
    got = I.smoothed(df, {"m": (F.col("x"), 0.2, 0), "late": (F.col("x"), 1 / 14, 1)}).orderBy("ticker", "date").toPandas()
    for ticker, own in got.groupby("ticker"):
        x = own["x"].reset_index(drop=True)
        np.testing.assert_allclose(own["m"], x.ewm(alpha=0.2, adjust=False).mean(), rtol=1e-9, atol=1e-12)
        late = x.where(x.index > 0).ewm(alpha=1 / 14, adjust=False).mean()
        np.testing.assert_allclose(own["late"].astype(float), late, rtol=1e-9, atol=1e-12)


def test_asof_without_tie_takes_the_largest_values(spark):
    left = spark.createDataFrame([("a", 5)], "k string, d int")
    right = spark.createDataFrame([("a", 3, 1), ("a", 3, 7), ("a", 3, 4)], "k string, d int, v int").repartition(3)
    assert A.asof_backward(left, right, ["k"], "d", "d", ["v"]).first()["v"] == 7
