"""Steps that must not depend on how rows are dealt, nor send many rows where few are expected."""

import datetime as dt
from itertools import permutations

import pytest

from assay.operators import montecarlo as MC
from assay.operators import prices as P
from assay.operators import recommend as R
from assay.plans import queries_predictor as QP
from assay.plans.views import Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_draws_of_a_permutation_do_not_pass_the_driver(table):
    signals = table("ticker string, date date, score double, stock_return double, spy_return double", [
        (f"t{i}", f"2024-01-0{d}", 80 + i, i, 0) for d in range(1, 5) for i in range(9)])
    got = MC.null_alphas(signals, 20, 3, 42)
    assert len(got.collect()) == 20
    text = plan(got)  # the plan that ran: sizes were known by then
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text


@pytest.mark.parametrize("name", ["features", "event_outcomes"])
def test_means_do_not_depend_on_the_order_of_the_rows(spark, tmp_path, name):
    # added in the order of their ids the mean of these values is a multiple of the unit; in other orders it is just less or more
    unit = 17 if name == "features" else 23
    values = next(v for v in _orders(3 * unit) if (v[0] + v[1] + v[2]) / 3 == unit)
    day = dt.datetime(2024, 1, 3, 12)
    events = [(i, day, 7, "view", v, "{}") for i, v in enumerate(values)]
    seen = set()
    for k, order in enumerate(permutations(events)):
        folder = str(tmp_path / str(k))
        spark.createDataFrame(
            order, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{folder}/events.parquet")
        seen |= {tuple(r) for r in Tables(spark, folder)._view(name).select("momentum_20d" if name == "features" else "actual_5d_return").collect()}
    assert len(seen) == 1 and (name != "features" or seen == {(-8.0,)})


def _orders(total):
    """Lists of three values with two decimals whose sum depends on their order."""
    for a in range(1, 1600):
        for b in range(a, 1600, 7):
            v = [a / 100, b / 100, round(total - a / 100 - b / 100, 2)]
            sums = {(v[0] + v[1]) + v[2], (v[2] + v[1]) + v[0], (v[0] + v[2]) + v[1]}
            if min(sums) < total:
                yield v


def test_nearly_unique_keys_are_dealt_before_they_are_aggregated(spark):
    for name, base in (("cells", "lineitem"), ("predictor_outcomes", "orders")):
        text = plan(Tables(spark, "/root/testdata/sf0.001")._view(name))
        below = text[text.index("Exchange"):]
        assert "Aggregate" not in below and text.count("Exchange") == 1, name


def test_matched_signals_carry_only_what_is_read(spark):
    got = set(QP.matched(Tables(spark, "/root/testdata/sf0.001")).columns)
    assert got == {"symbol", "score_date", "score", "sector", "beat_spy_10d", "return_10d", "matched_date",
                   "predicted_direction", "prediction_confidence"}


def test_time_split_keeps_rows_without_a_date_and_joins_nothing(table):
    signals = table("d date, s string, i int", [
        (None, "a", 0), (None, None, 1), ("2024-01-01", None, 2), ("2024-01-01", "a", 3), ("2024-01-01", "a", 4), ("2024-01-02", "a", 5)])
    for k in range(7):
        split = R.time_split(signals, k / 6, "d", "s", ["i"])
        order = [1, 0, 2, 3, 4, 5]
        assert {r.i for r in split.filter("in_train").collect()} == set(order[:k]), k
        assert split.count() == 6
    assert "Join" not in plan(R.time_split(signals, 0.5, "d", "s", ["i"]))


def test_filled_days_are_not_shuffled(table):
    bars = table("ticker string, date date, close double", [("x", "2024-01-01", 1), ("y", "2024-01-03", 2)])
    cal = table("date date, pos long", [("2024-01-01", 0), ("2024-01-02", 1), ("2024-01-03", 2)])
    spark = bars.sparkSession
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = P.price_matrix(bars, cal)
        assert "SortMergeJoin" not in plan(got) and got.count() == 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
