import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assay.functions import aggregates as A
from assay.functions import ranks as R
from assay.functions import scalars as S
from assay.functions.significance import benjamini_hochberg, pearson_p_value


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_rounding_is_stable_against_sum_noise(spark):
    a, b = 0.12345, math.nextafter(0.12345, 0)
    r = one(spark, S.rnd(F.lit(a), 4), S.rnd(F.lit(b), 4), S.rnd(F.lit(-0.00004), 4))
    assert r[0] == r[1] == 0.1235 and r[2] == 0.0


def test_wilson_interval(spark):
    lo, hi = S.wilson_bounds(F.lit(7), F.lit(10))
    z0 = S.wilson_bounds(F.lit(0), F.lit(0))
    r = one(spark, lo, hi, *z0)
    assert (r[0], r[1]) == (0.3968, 0.8922) and (r[2], r[3]) == (0.0, 0.0)


def test_normal_cdf(spark):
    r = one(spark, *[S.norm_cdf(F.lit(z)) for z in (0.0, 1.96, -1.0)])
    assert r[0] == pytest.approx(0.5, abs=1e-6) and r[1] == pytest.approx(0.9750021, abs=1e-6)
    assert r[2] == pytest.approx(0.1586553, abs=1e-6)


def test_text_categories(spark):
    df = spark.createDataFrame([("Deep PULLBACK",), ("late expiry",), ("",), (None,), ("gap",)], "t string")
    got = [r[0] for r in df.select(S.keyword_category("t", S.POST_TRADE_TRIGGERS)).collect()]
    assert got == ["pullback", "time_expiry", "unknown", "unknown", "other"]
    df = spark.createDataFrame([("2024-01-02T09:59:00",), ("10:00:01",), ("13:59",), ("14:00",), ("open",)], "t string")
    got = [r[0] for r in df.select(S.time_of_day("t")).collect()]
    assert got == ["early (pre-10)", "morning (10-12)", "midday (12-14)", "afternoon (14+)", "unknown"]


def test_direction_limits_are_strict(spark):
    r = one(spark, *[S.direction_of(F.lit(x)) for x in (0.005, 0.0051, -0.005, -0.0051)])
    assert tuple(r) == ("FLAT", "UP", "FLAT", "DOWN")


def test_technical_pieces(spark):
    r = one(
        spark, S.rsi_score(F.lit(70.0), F.lit("neutral")), S.rsi_score(F.lit(30.0), F.lit("neutral")),
        S.rsi_score(F.lit(50.0), F.lit("bear")), S.macd_score(F.lit(1.0), F.lit(False)),
        S.average_distance_score(F.lit(None).cast("double")), S.average_distance_score(F.lit(-5.0)),
        S.average_distance_score(F.lit(5.0)), S.momentum_score(F.lit(None).cast("double")))
    assert r[0] == 0.0 and r[1] == 100.0 and r[2] == pytest.approx(65 * 20 / 30) and r[3] == 70.0
    assert (r[4], r[5], r[6], r[7]) == (50.0, 30.0, 80.0, 50.0)


def test_grade_scales(spark):
    r = one(
        spark, S.pct_grade(F.lit(0.5), 0.5, 0.8), S.pct_grade(F.lit(0.8), 0.5, 0.8), S.lift_grade(F.lit(0.0), -2.0, 3.0),
        S.lift_grade(F.lit(-2.0), -2.0, 3.0), S.lift_grade(F.lit(9.0), -2.0, 3.0), S.ic_grade(F.lit(0.05)),
        S.ratio_grade(F.lit(0.75), 0.75), S.ratio_grade(F.lit(1.2), 0.75), S.pct_grade(F.lit(None).cast("double"), 0.5, 0.8),
        S.letter(F.lit(90.0)), S.letter(F.lit(19.9)), S.letter(F.lit(None).cast("double")))
    assert tuple(r)[:5] == pytest.approx((30.0, 95.0, 40.0, 0.0, 100.0))
    assert r[5] == pytest.approx(55.0) and (r[6], r[7], r[8]) == (80.0, 100.0, None)
    assert tuple(r)[9:] == ("A", "F", "N/A")


def test_drawdown_tiers_and_trials(spark):
    r = one(spark, *[S.drawdown_multiplier(F.lit(d), F.lit(0.08)) for d in (-0.01, -0.02, -0.05, -0.07, -0.08)])
    assert tuple(r) == (1.0, 0.75, 0.5, 0.25, 0.0)
    r = one(spark, S.random_trials_needed(F.lit(0.05), F.lit(0.95)), S.automatic_trials(F.lit(972)),
            S.automatic_trials(F.lit(40)), S.automatic_trials(F.lit(5000)))
    assert tuple(r) == (59, 243, 40, 400)


def test_pearson_on_flat_and_missing_values(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 9.0, 5.0)], "x double, y double, k double")
    r = df.agg(A.pearson("x", "y"), A.pearson("x", "k"), A.pearson("x", "y", 10)).first()
    assert r[0] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4, 9])[0, 1]) and r[1] is None and r[2] is None


def test_sample_skewness(spark):
    x = [1.0, 2.0, 2.5, 9.0, 4.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    assert df.agg(A.sample_skewness(F.col("x"))).first()[0] == pytest.approx(pd.Series(x).skew())
    assert df.limit(2).agg(A.sample_skewness(F.col("x"))).first()[0] is None


def frame(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({
        # one value holds a third of the rows, one group two thirds
        "g": np.where(rng.random(900) < 0.66, "hot", rng.choice(["a", "b"], 900)),
        "x": np.where(rng.random(900) < 0.33, 7.0, np.round(rng.normal(size=900), 2)),
        "y": np.round(rng.normal(size=900), 1),
    })
    return pdf, spark.createDataFrame(pdf).repartition(5)


def test_average_ranks_match_pandas(spark):
    pdf, df = frame(spark)
    want = pdf.assign(r=pdf.groupby("g")["x"].rank())
    got = R.with_average_rank(df, ["g"], "x", "r").toPandas()
    a = want.sort_values(["g", "x", "y"])[["g", "x", "r"]].reset_index(drop=True)
    b = got.sort_values(["g", "x", "y"])[["g", "x", "r"]].reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)


def test_exact_quantiles_match_numpy(spark):
    pdf, df = frame(spark)
    got = {(r["g"], r["p"]): r["quantile"] for r in R.exact_quantiles(df, ["g"], "x", [0.0, 0.2, 0.5, 0.77, 1.0]).collect()}
    for g, part in pdf.groupby("g"):
        for p in (0.0, 0.2, 0.5, 0.77, 1.0):
            assert got[(g, p)] == pytest.approx(np.quantile(part["x"], p))


def test_quantiles_do_not_depend_on_partitioning(spark):
    _, df = frame(spark)
    a = R.exact_quantiles(df.repartition(1), [], "x", [0.5]).first()["quantile"]
    b = R.exact_quantiles(df.repartition(17, "y"), [], "x", [0.5]).first()["quantile"]
    assert a == b


def test_spearman_matches_pandas(spark):
    pdf, df = frame(spark)
    got = {r["g"]: r["rank_ic"] for r in R.spearman(df, ["g"], "x", "y").collect()}
    for g, part in pdf.groupby("g"):
        assert got[g] == pytest.approx(part["x"].rank().corr(part["y"].rank()))


def test_numbered_by_id(spark):
    ids = [5, 1, 2_000_007, 12, 999_999, 1_000_000]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = [r["row_no"] for r in R.numbered_by_id(df, "id").orderBy("id").collect()]
    assert got == list(range(6))
    assert R.numbered_by_id(df, "id").select("row_no_total").distinct().collect()[0][0] == 6


def test_blocks_grow_with_distinct_values(spark, monkeypatch):
    """Values that are all distinct: more of them, more blocks; ranks stay exact."""
    monkeypatch.setattr(R, "SPLIT", 16)
    blocks = {}
    for n in (500, 4000):
        df = spark.range(n).select((F.col("id") * 7919 % n).alias("v"))
        blocked, offsets = R._blocked_counts(df, [], "v")
        blocks[n] = offsets.count()
        assert offsets.agg(F.sum("block_n")).first()[0] == n
        ranks = R.average_ranks(df, [], "v")
        assert ranks.filter("avg_rank <> v + 1").count() == 0 and ranks.count() == n
    assert blocks[4000] > 2 * blocks[500] > 0
    assert blocks[4000] <= 65 + 4000 / 16 * 1.5


def test_sparse_ids_need_few_blocks(spark):
    df = spark.range(3000).select((F.col("id") * 10**12).alias("id"))
    got = R.numbered_by_id(df, "id")
    assert got.filter("row_no <> id / 1000000000000").count() == 0
    cuts = R._with_parts(df.agg(*R._cut_columns("id")))
    sizes = R.with_scalars(df, cuts).groupBy(R._block_of(F.col("id")).alias("b")).count().agg(F.count("*"), F.max("count")).first()
    assert sizes[0] <= 70 and sizes[1] <= 3000 / 64 * 3


def test_step_up_correction(spark):
    ps = [0.001, 0.02, 0.039, 0.041, 0.6, 0.02, None]
    df = spark.createDataFrame(list(enumerate(ps)), "i int, p double")
    got = {r["i"]: r["sig"] for r in benjamini_hochberg(df, "p", "sig").collect()}
    m = sorted(p for p in ps if p is not None)
    k = max((i + 1 for i, p in enumerate(m) if p <= (i + 1) / len(m) * 0.05), default=0)
    limit = m[k - 1] if k else -1
    assert got == {i: p is not None and p <= limit for i, p in enumerate(ps)}


def test_pearson_p_value(spark):
    df = spark.createDataFrame([(0.5, 20), (0.0, 30), (1.0, 10), (0.9, 2), (None, 9)], "r double, n int")
    got = [r[0] for r in df.select(pearson_p_value("r", "n")).collect()]
    assert got[0] == pytest.approx(0.0247694, abs=1e-6) and got[1] == pytest.approx(1.0)
    assert got[2] == 0.0 and got[3] is None and got[4] is None
    # one degree of freedom by hand; many rows against the normal tail
    more = spark.createDataFrame([(0.6, 3), (0.002, 1_000_000), (0.0065, 100_000), (0.95, 200)], "r double, n int")
    got = [r[0] for r in more.select(pearson_p_value("r", "n")).collect()]
    assert got[0] == pytest.approx(1 - 2 / np.pi * np.arcsin(0.6), abs=1e-9)
    assert got[1] == pytest.approx(0.0455003, abs=1e-5) and got[2] == pytest.approx(0.0398, abs=1e-4) and got[3] < 1e-12


def test_rounding_passes_through_what_has_no_digits_left(spark):
    import math

    values = [float("nan"), float("inf"), float("-inf"), 1e16, -3.5e15, 2.00005, -1.23456, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r["x"] for r in df.orderBy("i").select(S.rnd("v", 4).alias("x")).collect()]
    assert math.isnan(got[0]) and got[1:3] == [float("inf"), float("-inf")]
    assert got[3:] == [1e16, -3.5e15, 2.0001, -1.2346, None]
