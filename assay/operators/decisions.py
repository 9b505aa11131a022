"""Entry and exit rules for many parameter combinations at once.

The rules are stateless given a portfolio snapshot, so a whole history of
(combination, date) states is judged in one plan.  Candidates meet combinations
through the state of their date, an equi-join; rule order is the order of one
``when`` chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.functions import scalars as S
from assay.operators.portfolio import mean_correlations

# Parameter defaults of the entry and exit rules.
ENTRY_DEFAULTS: dict[str, object] = {
    "min_score": 70.0, "momentum_gate_enabled": True, "momentum_gate_threshold": -5.0,
    "max_position_pct": 0.05, "bear_max_position_pct": 0.025, "max_sector_pct": 0.25, "max_equity_pct": 0.90,
    "bear_block_underweight": True, "sector_adj_overweight": 1.05, "sector_adj_market_weight": 1.00,
    "sector_adj_underweight": 0.85, "conviction_decline_adj": 0.70, "upside_fail_adj": 0.70,
    "min_price_target_upside": 0.05, "atr_sizing_enabled": True, "atr_sizing_target_risk": 0.02,
    "atr_sizing_floor": 0.5, "atr_sizing_ceiling": 1.5, "confidence_sizing_enabled": True,
    "confidence_sizing_min": 0.7, "confidence_sizing_range": 0.6, "use_p_up_sizing": False, "p_up_sizing_blend": 0.3,
    "staleness_discount_enabled": True, "signal_cadence_days": 7, "staleness_decay_per_day": 0.03,
    "staleness_floor": 0.70, "earnings_sizing_enabled": True, "earnings_proximity_days": 5,
    "earnings_sizing_reduction": 0.50, "coverage_sizing_enabled": True, "coverage_derate_floor": 0.25,
    "min_position_dollar": 500.0, "correlation_block_enabled": True, "correlation_block_threshold": 0.80,
    "circuit_breaker": 0.08,
}
EXIT_DEFAULTS: dict[str, object] = {
    "atr_trailing_enabled": True, "fallback_stop_enabled": True, "profit_take_enabled": True,
    "momentum_exit_enabled": True, "time_decay_enabled": True, "sector_relative_veto_enabled": True,
    "atr_multiplier": 2.5, "fallback_stop_pct": 0.10, "profit_take_pct": 0.25, "momentum_exit_threshold": -15.0,
    "momentum_exit_rsi": 30.0, "time_decay_reduce_days": 7, "time_decay_exit_days": 14,
    "sector_relative_outperform_threshold": 0.05, "reduce_fraction": 0.50,
}


def with_defaults(combos: DataFrame, defaults: dict[str, object], nested: str | None = None) -> DataFrame:
    """Every parameter as a column: the nested value if set, else the flat one, else the default."""
    inner = combos.schema[nested].dataType.fieldNames() if nested and nested in combos.columns else []
    cols = []
    for name, value in defaults.items():
        found = ([F.col(f"{nested}.{name}")] if name in inner else []) + (
            [F.col(name)] if name in combos.columns else [])
        cols.append(F.coalesce(*found, F.lit(value)).alias(name))
    return combos.select("combo_id", *cols)


def candidate_rows(buys: DataFrame, latest: DataFrame, predictions: DataFrame, calendar_days: DataFrame | None = None) -> DataFrame:
    """Buy signals with ATR share, coverage, prediction and earnings attached."""
    d = buys.join(latest.select("ticker", F.col("atr_14_pct").alias("atr_pct"), "coverage"), "ticker", "left")
    d = d.join(predictions.select("ticker", "date", F.col("prediction_confidence").alias("confidence"), "p_up",
                                  (F.col("predicted_direction") == "DOWN").alias("__down")), ["ticker", "date"], "left")
    d = d.withColumn("model_veto", F.coalesce("__down", F.lit(False))).drop("__down")
    if calendar_days is not None:
        d = d.join(calendar_days.select("ticker", "days_to_earnings"), "ticker", "left")
    return d


def size_positions(c: DataFrame) -> DataFrame:
    """Weight, dollars and whole shares of each candidate under its combination."""
    bear = F.col("market_regime") == "bear"
    cap = F.when(bear, F.col("bear_max_position_pct")).otherwise(F.col("max_position_pct"))
    base = F.lit(1.0) / F.greatest(F.col("n_candidates"), F.lit(1))
    atr = S.atr_multiplier("atr_pct", "atr_sizing_enabled", "atr_sizing_target_risk", "atr_sizing_floor",
                           "atr_sizing_ceiling")
    d = c.withColumns({"position_cap": cap, "base_weight": base, "atr_adj": atr, "adjustment": (
        S.sector_multiplier("sector_rating", "sector_adj_overweight", "sector_adj_market_weight", "sector_adj_underweight")
        * S.conviction_multiplier("conviction", "conviction_decline_adj")
        * S.upside_multiplier("upside", "min_price_target_upside", "upside_fail_adj")
        * S.confidence_multiplier("confidence", "p_up", "confidence_sizing_enabled", "confidence_sizing_min",
                                  "confidence_sizing_range", "use_p_up_sizing", "p_up_sizing_blend")
        * S.staleness_multiplier("signal_age_days", "staleness_discount_enabled", "signal_cadence_days",
                                 "staleness_decay_per_day", "staleness_floor")
        * S.earnings_multiplier("days_to_earnings", "earnings_sizing_enabled", "earnings_proximity_days",
                                "earnings_sizing_reduction")
        * S.coverage_multiplier("coverage", "coverage_sizing_enabled", "coverage_derate_floor"))})
    weight = F.least(F.col("base_weight") * F.col("adjustment") * F.col("dd_multiplier") * F.col("atr_adj"),
                     F.col("position_cap"))
    limited = F.when(F.col("atr_adj") < 1.0, F.least(
        weight, F.col("base_weight") * F.col("atr_adj") * F.col("dd_multiplier"), F.col("position_cap"))).otherwise(weight)
    d = d.withColumn("position_weight", S.rnd(F.greatest(limited, F.lit(0.0)), 8))
    d = d.withColumn("dollars", S.rnd(F.col("nav") * F.col("position_weight"), 4))
    fits = (F.col("dollars") >= F.col("min_position_dollar")) & (F.col("price") > 0)
    # the small lift keeps a quotient that is whole but for float noise whole
    return d.withColumn("shares", F.when(fits, F.floor(F.col("dollars") / F.col("price") + 1e-9)).otherwise(0))


def gate(c: DataFrame, correlation: Column | None = None) -> Column:
    """First entry rule a candidate fails, NULL if none does."""
    bear = F.col("market_regime") == "bear"
    out = (
        F.when(F.col("held"), "already_held")
        .when(F.col("price").isNull() | (F.col("price") <= 0), "no_price")
        .when(F.col("score") < F.col("min_score"), "score")
        .when(F.col("momentum_gate_enabled") & (F.col("momentum_20d") < F.col("momentum_gate_threshold")), "momentum_gate")
        .when(F.col("dd_multiplier") <= 0, "drawdown_halt")
        .when(bear & F.col("bear_block_underweight") & (F.col("sector_rating") == "underweight"), "bear_underweight")
        .when(F.col("model_veto"), "model_veto")
        .when(F.col("position_weight") > F.col("position_cap") + 1e-12, "position_cap")
        .when(F.col("sector_value") + F.col("dollars") > F.col("max_sector_pct") * F.col("nav"), "sector_cap")
        .when(F.col("equity") + F.col("dollars") > F.col("max_equity_pct") * F.col("nav"), "equity_cap")
    )
    if correlation is not None:
        out = out.when(F.col("correlation_block_enabled")
                       & (correlation > F.col("correlation_block_threshold")), "correlation")
    return out.when(F.col("shares") <= 0, "zero_shares")


def entry_decisions(candidates: DataFrame, combos: DataFrame, state: DataFrame, held: DataFrame,
                    sectors: DataFrame, regimes: DataFrame, returns: DataFrame | None = None,
                    lookback: int = 60, means: DataFrame | None = None) -> DataFrame:
    """Block reason, weight, dollars and shares for every (combination, candidate).

    ``state``: (combo_id, date, pos, nav, equity, drawdown); ``held``: (combo_id,
    pos, ticker, value), or (ticker, pos, holdings) as in ``portfolio.book_bars``.  Caps look at each candidate alone.  Correlations are
    only worked out for candidates that pass every cheaper rule, against the
    names held in the same sector (a portfolio's worth of them), or taken from ``means`` (of ``portfolio.block_means``)
    where these are given; they are looked up once per (day, ticker) and not per combination.
    """
    conf = with_defaults(combos, ENTRY_DEFAULTS)
    if "holdings" in held.columns:
        mine = held.select("pos", "ticker", F.transform("holdings", lambda h: h["combo_id"]).alias("__holders"))
        each = held.join(sectors.select("ticker", "sector"), "ticker").select("pos", "sector", F.inline("holdings"))
    else:
        mine = held.groupBy("pos", "ticker").agg(F.collect_set("combo_id").alias("__holders"))
        each = held.join(sectors.select("ticker", "sector"), "ticker")
    sect = each.filter("sector IS NOT NULL").groupBy("combo_id", "pos", "sector").agg(F.sum("value").alias("sector_value"))
    sect = sect.groupBy("combo_id", "pos").agg(F.map_from_entries(F.collect_list(F.struct("sector", "sector_value"))).alias("__sectors"))
    # all that a day adds to its candidates is one row per calendar day, sent whole: its count and regime, and per
    # combination its state and sectors.  A crowded day stays dealt out, and nothing is shuffled once the candidates met
    # the (small) parameter table.
    n = candidates.groupBy("date").agg(F.count("*").alias("n_candidates"))
    days = state.join(sect, ["combo_id", "pos"], "left").groupBy("date", "pos").agg(
        F.collect_list(F.struct("combo_id", "nav", "equity", "drawdown", "__sectors")).alias("__states"))
    c = candidates.join(F.broadcast(n), "date").join(sectors.select("ticker", "sector"), "ticker", "left")
    c = c.join(F.broadcast(regimes.select("date", "market_regime")), "date", "left").withColumn(
        "market_regime", F.coalesce("market_regime", F.lit("neutral")))
    # who holds a candidate is looked up once per (day, ticker) and not per combination
    c = c.join(F.broadcast(state.select("date", "pos").distinct()), "date").join(mine, ["pos", "ticker"], "left")
    if means is not None:
        c = c.join(means.select("pos", "ticker", F.col("means").alias("__means")), ["pos", "ticker"], "left")
    d = c.join(F.broadcast(days), ["date", "pos"]).withColumn("s", F.explode("__states")).drop("__states").select("*", "s.*").drop("s")
    d = d.withColumns({
        "held": F.coalesce(F.array_contains("__holders", F.col("combo_id")), F.lit(False)),
        "sector_value": F.coalesce(F.try_element_at("__sectors", F.col("sector")), F.lit(0.0))}).drop("__holders", "__sectors")
    if means is not None:
        d = d.withColumn("__mean", S.rnd(F.try_element_at("__means", F.col("combo_id")), 8)).drop("__means")
    d = d.join(F.broadcast(conf), "combo_id").withColumn("dd_multiplier", S.drawdown_multiplier("drawdown", "circuit_breaker"))
    sized = size_positions(d)
    key = ["combo_id", "pos", "ticker"]
    if means is not None:
        judged = sized.withColumn("mean_correlation", F.when(gate(sized).isNull(), F.col("__mean")))
        judged = judged.withColumn("block_reason", gate(judged, F.col("mean_correlation")))
    elif returns is None:
        judged = sized.withColumn("mean_correlation", F.lit(None).cast("double")).withColumn("block_reason", gate(sized))
    else:
        open_ = sized.filter(gate(sized).isNull()).select(*key, "sector")
        each = held.select("pos", "ticker", F.inline("holdings")) if "holdings" in held.columns else held
        names = each.join(sectors.select("ticker", "sector"), "ticker").select(*key, "sector").distinct()
        mean = mean_correlations(open_, names, returns, ["combo_id", "sector"], lookback).select(
            *key, S.rnd("mean", 8).alias("mean_correlation"))
        judged = sized.join(mean, key, "left")
        judged = judged.withColumn("block_reason", gate(judged, F.col("mean_correlation")))
    passed = F.col("block_reason").isNull()
    return judged.select(
        "combo_id", "date", "ticker", "block_reason", passed.alias("entered"), "position_weight", "mean_correlation",
        F.when(passed, F.col("dollars")).otherwise(0.0).alias("dollars"),
        F.when(passed, F.col("shares")).otherwise(0).alias("shares"), "price")


def exit_decisions(positions: DataFrame, combos: DataFrame, market: DataFrame, sectors: DataFrame,
                   funds: DataFrame, actions: DataFrame, cal: DataFrame) -> DataFrame:
    """Action, reason and shares for every held position and day.

    Trailing stop, fallback stop, profit take, momentum, time decay, in this
    order.  A trailing stop that is called off because the stock beats its sector
    does not fall through to the fallback stop.
    """
    days = cal.select("pos", "date")
    # the market columns replace those the position was marked with
    p = positions.drop("close", "high", "value", "date").join(days, "pos")
    d = p.join(
        market.select("ticker", "date", "close", "atr_dollar", "rsi_14", "momentum_20d", "lookback_return"),
        ["ticker", "date"], "left")
    d = d.join(sectors.select("ticker", "sector_etf"), "ticker", "left").join(
        funds.select("sector_etf", "date", "fund_return"), ["sector_etf", "date"], "left")
    d = d.join(actions.select("ticker", "date", "research_action"), ["ticker", "date"], "left")
    return judged_exits(d, combos, cal)


def judged_exits(positions: DataFrame, combos: DataFrame, cal: DataFrame) -> DataFrame:
    """``exit_decisions`` of positions that carry the market columns, fund return and research action of their day.
    Only the parameters and the calendar are joined; both are small and sent whole."""
    conf = F.broadcast(with_defaults(combos, EXIT_DEFAULTS))
    entry_pos = F.broadcast(cal.select(F.col("date").alias("entry_date"), F.col("pos").alias("entry_pos")))
    d = positions if "date" in positions.columns else positions.join(F.broadcast(cal.select("pos", "date")), "pos")
    d = d.join(entry_pos, "entry_date").withColumn(
        "research_action", F.coalesce("research_action", F.lit("HOLD"))).join(conf, "combo_id")
    eligible = ~F.col("research_action").isin("EXIT", "REDUCE")
    yes = lambda cond: F.coalesce(cond, F.lit(False))
    cost = F.col("entry_price")
    trail = yes(eligible & F.col("atr_trailing_enabled")
                & (F.col("close") <= F.col("highest_high") - F.col("atr_dollar") * F.col("atr_multiplier")))
    spared = yes(F.col("sector_relative_veto_enabled")
                 & (F.col("lookback_return") - F.col("fund_return") > F.col("sector_relative_outperform_threshold")))
    fallback = yes(eligible & ~trail & F.col("fallback_stop_enabled") & (cost > 0)
                   & (F.col("close") <= cost * (1 - F.col("fallback_stop_pct"))))
    profit = yes(eligible & F.col("profit_take_enabled") & (cost > 0)
                 & ((F.col("close") - cost) / cost >= F.col("profit_take_pct")))
    weak = yes(eligible & F.col("momentum_exit_enabled") & (F.col("momentum_20d") < F.col("momentum_exit_threshold"))
               & (F.col("rsi_14") < F.col("momentum_exit_rsi")))
    bars_held = F.col("pos") - F.col("entry_pos")
    aged = eligible & F.col("time_decay_enabled") & (F.col("research_action") == "HOLD")
    reason = (
        F.when(trail & ~spared, "atr_trailing_stop").when(fallback, "fallback_stop").when(profit, "profit_take")
        .when(weak, "momentum_exit").when(aged & (bars_held >= F.col("time_decay_exit_days")), "time_decay_exit")
        .when(aged & (bars_held >= F.col("time_decay_reduce_days")), "time_decay_reduce")
    )
    d = d.withColumns({"reason": reason, "bars_held": bars_held})
    reduce_ = F.col("reason").isin("profit_take", "time_decay_reduce")
    part = F.floor(F.col("shares") * F.col("reduce_fraction") + 1e-9)
    sells = F.when(F.col("reason").isNull(), 0).when(reduce_, part).otherwise(F.col("shares"))
    d = d.withColumn("exit_shares", sells)
    void = yes(reduce_) & (F.col("exit_shares") == 0)
    return d.select(
        "combo_id", "date", "ticker", "shares", "bars_held", "highest_high",
        F.when(F.col("reason").isNull() | void, "NONE").when(reduce_, "REDUCE").otherwise("EXIT").alias("exit_action"),
        F.when(~void, F.col("reason")).alias("exit_reason"), F.col("exit_shares").cast("double").alias("exit_shares"))


def research_actions(signals: DataFrame) -> DataFrame:
    """One action per (date, ticker): REDUCE over EXIT over ENTER over HOLD."""
    order = F.when(F.col("signal") == "REDUCE", 3).when(F.col("signal") == "EXIT", 2).when(
        F.col("signal") == "ENTER", 1).otherwise(0)
    best = F.max(order)
    return signals.groupBy("date", "ticker").agg(
        F.when(best == 3, "REDUCE").when(best == 2, "EXIT").when(best == 1, "ENTER").otherwise("HOLD")
        .alias("research_action"))

