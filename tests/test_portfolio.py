import math

import pytest
from pyspark.sql import functions as F

from assay.operators import decisions as D
from assay.operators import portfolio as PF
from assay.operators.asof import calendar
from tests.conftest import rows

ORDERS = "combo_id int, seq long, date date, ticker string, action string, shares double, price double"


def nav_table(table, series):
    return table("combo_id int, date date, nav double", [
        (c, f"2024-01-{i + 1:02d}", v) for c, vs in series.items() for i, v in enumerate(vs)])


def test_nav_statistics_by_hand(table):
    nav = nav_table(table, {1: [100, 110, 99, 121], 2: [100, 100, 100], 3: [100], 4: [100, 0, 50]})
    got = {r["combo_id"]: r for r in PF.nav_statistics(nav, 100.0).collect()}
    r = got[1]
    rets = [0.1, -0.1, 121 / 99 - 1]
    m = sum(rets) / 3
    s = math.sqrt(sum((x - m) ** 2 for x in rets) / 2)
    assert r["total_return"] == pytest.approx(0.21) and r["max_drawdown"] == pytest.approx(-0.1)
    assert r["sharpe_ratio"] == pytest.approx(m / s * math.sqrt(252))
    assert r["calmar_ratio"] == pytest.approx((1.21 ** (252 / 4) - 1) / 0.1)
    assert (got[2]["sharpe_ratio"], got[2]["max_drawdown"], got[2]["calmar_ratio"]) == (0.0, 0.0, 0.0)
    assert (got[3]["sharpe_ratio"], got[3]["calmar_ratio"]) == (0.0, 0.0)
    daily = rows(PF.with_drawdown(nav).filter("combo_id = 4").select("date", "daily_return", "drawdown").drop("date"))
    assert (0.0, -0.5) in daily and (-1.0, -1.0) in daily  # flat after a wipe-out
    assert got[4]["max_drawdown"] == -1.0


def test_trade_pairing(table):
    o = table(ORDERS, [
        (1, 1, "2024-01-01", "a", "ENTER", 10, 100), (1, 2, "2024-01-02", "a", "REDUCE", 5, 120), (1, 3, "2024-01-03", "a", "EXIT", 5, 110),
        (1, 4, "2024-01-04", "a", "ENTER", 10, 100), (1, 5, "2024-01-05", "a", "ENTER", 10, 130), (1, 6, "2024-01-06", "a", "EXIT", 10, 120),
        (1, 7, "2024-01-07", "a", "EXIT", 10, 500), (2, 8, "2024-01-01", "b", "EXIT", 1, 1)])
    got = {r["combo_id"]: r for r in PF.trade_counts(o).collect()}
    assert (got[1]["total_orders"], got[1]["total_trades"], got[1]["wins"]) == (7, 2, 1)
    assert (got[2]["total_trades"], got[2]["win_rate"]) == (0, 0.0)


def brute_nav(orders, prices, days, cash0, fee):
    """Day by day: mark first, then trade; ENTER assigns, sells are clamped."""
    cash, pos, out = cash0, {}, []
    for d in days:
        out.append(cash + sum(s * (prices.get((t, d)) or 0.0) for t, s in pos.items()))
        for _, seq, od, t, action, s, p in sorted(o for o in orders if o[2] == d):
            if action == "ENTER":
                pos[t] = s
                cash -= s * p * (1 + fee)
            else:
                sold = min(s, pos.get(t, 0.0))
                pos[t] = pos.get(t, 0.0) - sold
                cash += sold * p * (1 - fee)
    return out


def test_nav_matches_a_daily_loop(table):
    days = [f"2024-01-{d:02d}" for d in range(1, 13)]
    orders = [
        (1, 1, days[0], "a", "ENTER", 10.0, 100.0), (1, 2, days[2], "a", "REDUCE", 4.0, 105.0), (1, 3, days[2], "a", "REDUCE", 4.0, 106.0),
        (1, 4, days[4], "a", "EXIT", 99.0, 90.0), (1, 5, days[5], "a", "EXIT", 5.0, 90.0), (1, 6, days[6], "a", "ENTER", 3.0, 80.0),
        (1, 7, days[7], "a", "ENTER", 7.0, 85.0), (1, 8, days[3], "b", "EXIT", 2.0, 50.0), (1, 9, days[8], "b", "ENTER", 2.0, 50.0)]
    prices = {(t, d): 100.0 + i * (1 if t == "a" else -2) for t in "ab" for i, d in enumerate(days) if not (t == "a" and i == 3)}
    bars = table("ticker string, date date, close double, high double", [(t, d, p, p + 1) for (t, d), p in prices.items()])
    cal = calendar(bars)
    ex = PF.executed_orders(table(ORDERS, orders), 0.001)
    nav = PF.nav_history(ex, cal, bars, 5000.0).orderBy("date").collect()
    assert [r["nav"] for r in nav] == pytest.approx(brute_nav(orders, prices, days, 5000.0, 0.001))
    hh = {(r["ticker"], r["pos"]): r["highest_high"] for r in PF.highest_since_entry(PF.marked_positions(ex, cal, bars)).collect()}
    assert hh[("a", 1)] == 102.0 and hh[("a", 3)] == 103.0  # no bar on the fourth day
    assert hh[("a", 8)] == 109.0  # the second ENTER starts afresh


def test_combo_without_orders(table):
    nav = nav_table(table, {1: [100.0, 120.0]})
    o = table(ORDERS, [(1, 1, "2024-01-01", "a", "ENTER", 1, 1)])
    bench = PF.benchmark_return(table("date date, close double", [("2024-01-01", 10), ("2024-01-02", None), ("2024-01-03", 11)]),
                                table("date date", [("2024-01-01",), ("2024-01-02",), ("2024-01-03",)]))
    got = {r["combo_id"]: r for r in PF.combo_statistics(table("combo_id int", [(1,), (2,)]), nav, o, bench, 100.0).collect()}
    assert got[1]["status"] == "ok" and got[1]["total_alpha"] == pytest.approx(0.1)
    assert (got[2]["status"], got[2]["total_return"], got[2]["total_alpha"]) == ("no_orders", 0.0, -0.1)
    one_day = PF.benchmark_return(table("date date, close double", [("2024-01-01", 10)]), table("date date", [("2024-01-01",)]))
    assert one_day.first()[0] is None


CAND = ("ticker string, date date, score double, conviction string, sector_rating string, upside double, atr_pct double, confidence double, "
        "p_up double, days_to_earnings int, coverage double, momentum_20d double, model_veto boolean, signal_age_days int, price double")


def candidate(**kw):
    base = dict(ticker="a", date="2024-01-02", score=90.0, conviction="stable", sector_rating="market_weight", upside=None, atr_pct=None,
                confidence=None, p_up=None, days_to_earnings=None, coverage=None, momentum_20d=None, model_veto=False, signal_age_days=0, price=10.0)
    return tuple({**base, **kw}.values())


def decide(table, cands, nav=100_000.0, equity=0.0, dd=0.0, held=(), regime="neutral", **params):
    combos = table("combo_id int", [(1,)])
    for k, v in params.items():
        combos = combos.withColumn(k, F.lit(v))
    state = table("combo_id int, date date, pos int, nav double, equity double, drawdown double", [(1, "2024-01-02", 1, nav, equity, dd)])
    h = table("combo_id int, pos int, ticker string, value double", [(1, 1, t, v) for t, v in held])
    sectors = table("ticker string, sector string", [("a", "X"), ("b", "X"), ("c", "Y")])
    regimes = table("date date, market_regime string", [("2024-01-02", regime)])
    out = D.entry_decisions(table(CAND, cands), combos, state, h, sectors, regimes)
    return {r["ticker"]: r for r in out.collect()}


@pytest.mark.parametrize("kw, env, reason", [
    ({}, {"held": [("a", 1.0)]}, "already_held"), ({"price": None}, {}, "no_price"), ({"score": 60.0, "model_veto": True}, {}, "score"),
    ({"momentum_20d": -6.0}, {}, "momentum_gate"), ({}, {"dd": -0.08}, "drawdown_halt"),
    ({"sector_rating": "underweight"}, {"regime": "bear"}, "bear_underweight"), ({"model_veto": True}, {}, "model_veto"),
    ({}, {"held": [("b", 24_900.0)]}, "sector_cap"), ({}, {"equity": 89_000.0}, "equity_cap"),
    ({}, {"nav": 1_000.0}, "zero_shares"), ({}, {}, None),
])
def test_entry_gates(table, kw, env, reason):
    r = decide(table, [candidate(**kw)], **env)["a"]
    assert r["block_reason"] == reason and r["entered"] == (reason is None)
    assert (r["shares"] > 0) == (reason is None)


def test_position_size(table):
    r = decide(table, [candidate(), candidate(ticker="c", conviction="declining", upside=0.01, atr_pct=0.04, confidence=0.5,
                                              days_to_earnings=3, coverage=0.1, signal_age_days=10)], max_position_pct=0.5)
    assert r["a"]["position_weight"] == pytest.approx(0.5) and r["a"]["block_reason"] == "sector_cap"
    w = 0.5 * 0.7 * 0.7 * 0.5 * (0.7 + 0.6 * 0.5) * (1 - 0.03 * 3) * 0.5 * 0.25
    assert r["c"]["position_weight"] == pytest.approx(w, abs=1e-8)
    assert r["c"]["shares"] == math.floor(100_000 * w / 10 + 1e-9)


def test_correlation_gate(spark, table):
    combos = table("combo_id int", [(1,)])
    ret = table("ticker string, pos int, ret double", [(t, p, (-1) ** p * 0.01 * (1 if t != "c" else -1)) for t in "abc" for p in range(60)])
    state = table("combo_id int, date date, pos int, nav double, equity double, drawdown double", [(1, "2024-01-02", 60, 1e6, 0, 0)])
    held = table("combo_id int, pos int, ticker string, value double", [(1, 60, "b", 10.0)])
    sectors = table("ticker string, sector string", [(t, "X") for t in "abc"])
    regimes = table("date date, market_regime string", [])
    out = D.entry_decisions(table(CAND, [candidate(), candidate(ticker="c")]), combos, state, held, sectors, regimes, ret)
    got = {r["ticker"]: (r["block_reason"], r["mean_correlation"]) for r in out.collect()}
    assert got["a"] == ("correlation", pytest.approx(1.0)) and got["c"] == (None, pytest.approx(-1.0))


def test_candidates_are_not_shuffled_once_they_met_the_combinations(spark, table):
    """Holdings as lists decide as rows do, and what a day adds is sent whole: no shuffle per candidate and combination."""
    combos = table("combo_id int", [(1,), (2,), (3,)])
    state = table("combo_id int, date date, pos int, nav double, equity double, drawdown double",
                  [(k, d, p, 1e5, 2e4, 0.0) for k in (1, 2) for d, p in (("2024-01-02", 1), ("2024-01-03", 2))])
    held = [(1, 1, "b", 24_900.0), (2, 1, "a", 10.0), (2, 2, "c", 5.0), (1, 2, "z", 1.0)]
    rows_ = table("combo_id int, pos int, ticker string, value double", held)
    lists = table("ticker string, pos int, holdings array<struct<combo_id:int,value:double>>", [(t, p, [(k, v)]) for k, p, t, v in held])
    sectors = table("ticker string, sector string", [("a", "X"), ("b", "X"), ("c", None)])
    regimes = table("date date, market_regime string", [("2024-01-03", "bear")])
    cands = table(CAND, [candidate(), candidate(ticker="c"), candidate(date="2024-01-03"), candidate(date="2024-01-04"), candidate(ticker="u")])
    out = D.entry_decisions(cands, combos, state, lists, sectors, regimes)
    got = {(r.combo_id, str(r.date)[-1], r.ticker): r.block_reason for r in out.collect()}
    assert got == {(r.combo_id, str(r.date)[-1], r.ticker): r.block_reason for r in D.entry_decisions(cands, combos, state, rows_, sectors, regimes).collect()}
    assert len(got) == out.count() == 8 and got[1, "2", "a"] == "sector_cap" and got[2, "2", "a"] == "already_held" and got[1, "2", "c"] is None
    above = out._jdf.queryExecution().executedPlan().toString().split("Generate explode(__states")[0]
    assert above.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in above


POS = "combo_id int, ticker string, pos int, shares double, entry_price double, entry_date date, highest_high double"


def exits(table, close=100.0, shares=10.0, entry=100.0, high=100.0, atr=None, rsi=50.0, mom=0.0, look=None, fund=None, action=None, held_for=1, **params):
    days = [f"2024-01-{d:02d}" for d in range(1, 28)]
    cal = calendar(table("date date", [(d,) for d in days]))
    pos = table(POS, [(1, "a", held_for, shares, entry, days[0], high)])
    market = table("ticker string, date date, close double, atr_dollar double, rsi_14 double, momentum_20d double, lookback_return double",
                   [("a", days[held_for], close, atr, rsi, mom, look)])
    funds = table("sector_etf string, date date, fund_return double", [("E", days[held_for], fund)])
    acts = table("ticker string, date date, research_action string", [("a", days[held_for], action)] if action else [])
    combos = table("combo_id int", [(1,)])
    for k, v in params.items():
        combos = combos.withColumn(k, F.lit(v))
    r = D.exit_decisions(pos, combos, market, table("ticker string, sector_etf string", [("a", "E")]), funds, acts, cal).first()
    return r["exit_action"], r["exit_reason"], r["exit_shares"]


def test_exit_rules(table):
    assert exits(table, close=90, high=120, atr=4.0) == ("EXIT", "atr_trailing_stop", 10.0)
    # beating the sector calls the stop off, and the fallback stop does not step in
    assert exits(table, close=85, high=120, atr=4.0, look=0.2, fund=0.0) == ("NONE", None, 0.0)
    assert exits(table, close=90) == ("EXIT", "fallback_stop", 10.0)
    assert exits(table, close=125) == ("REDUCE", "profit_take", 5.0)
    assert exits(table, close=125, shares=1.0) == ("NONE", None, 0.0)
    assert exits(table, mom=-16.0, rsi=29.0) == ("EXIT", "momentum_exit", 10.0)
    assert exits(table, held_for=14) == ("EXIT", "time_decay_exit", 10.0)
    assert exits(table, held_for=7) == ("REDUCE", "time_decay_reduce", 5.0)
    assert exits(table, held_for=14, action="ENTER") == ("NONE", None, 0.0)
    assert exits(table, close=50, action="EXIT") == ("NONE", None, 0.0)
    assert exits(table, close=None) == ("NONE", None, 0.0)
    assert exits(table, close=90, fallback_stop_enabled=False) == ("NONE", None, 0.0)


def test_nested_parameters_win(table):
    c = table("combo_id int, profit_take_pct double", [(1, 0.1), (2, 0.1)]).withColumn(
        "strategy", F.struct(F.when(F.col("combo_id") == 1, 0.3).alias("profit_take_pct")))
    got = D.with_defaults(c, D.EXIT_DEFAULTS, "strategy")
    assert rows(got.select("combo_id", "profit_take_pct", "reduce_fraction")) == [(1, 0.3, 0.5), (2, 0.1, 0.5)]


def test_research_action_order(table):
    s = table("date date, ticker string, signal string", [
        ("2024-01-01", "a", "ENTER"), ("2024-01-01", "a", "EXIT"), ("2024-01-01", "b", "HOLD"), ("2024-01-01", "a", "REDUCE")])
    assert rows(D.research_actions(s).select("ticker", "research_action")) == [("a", "REDUCE"), ("b", "HOLD")]
