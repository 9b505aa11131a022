"""Value added at every stage of a selection pipeline.

Base table: one row per (ticker, eval_date) with forward returns.  Each stage
table is keyed the same way; joins are left to AQE, which splits a hot key and
broadcasts a side only when its measured size allows it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.aggregates import binary_counts, binary_metrics
from assay.functions.frames import with_scalars
from assay.functions.scalars import rnd

KEYS = ["ticker", "eval_date"]
RATES = ["precision", "recall", "f1", "accuracy", "tp", "fp", "fn", "tn", "n"]


def resolved_universe(universe: DataFrame, eval_date=None) -> DataFrame:
    if eval_date is not None:
        universe = universe.filter(F.col("eval_date") == F.lit(eval_date).cast("date"))
    return universe.filter(F.col("return_5d").isNotNull())


def universe_status(universe: DataFrame) -> DataFrame:
    """Dates are counted before unresolved rows are dropped, rows after."""
    dates = universe.select("eval_date").distinct().agg(F.count("*").alias("n_dates"))
    rows = universe.agg(F.count("return_5d").alias("n_universe_rows"))
    return with_scalars(dates, rows).withColumn(
        "status", F.when(F.col("n_universe_rows") > 0, "ok").otherwise("insufficient_data"))


def attribution_table(universe, scanner, teams, committee, predictions, trades=None, blocked=None,
                      eval_date=None) -> DataFrame:
    """The universe with what every stage said about it, one wide row each."""
    if eval_date is not None:
        universe = universe.filter(F.col("eval_date") == F.lit(eval_date).cast("date"))
    c = F.col
    stages = [
        scanner.select(*KEYS, "tech_score", "scan_path", "quant_filter_pass", "liquidity_pass",
                       "volatility_pass", "balance_sheet_pass", "filter_fail_reason"),
        teams.select(*KEYS, "team_id", "quant_rank", c("quant_score").alias("team_quant_score"),
                     c("qual_score").alias("team_qual_score"), "team_recommended"),
        committee.select(*KEYS, c("combined_score").alias("cio_combined_score"),
                         c("macro_shift").alias("cio_macro_shift"),
                         c("final_score").alias("cio_final_score"),
                         "cio_decision", "cio_conviction", "cio_rank"),
        predictions.select(c("symbol").alias("ticker"), c("prediction_date").alias("eval_date"),
                           "predicted_direction", "prediction_confidence", "p_up", "p_down",
                           c("actual_5d_return").alias("predictor_actual_5d")),
    ]
    if trades is not None:
        stages.append(trades.filter(c("action") == "ENTER").select(
            "ticker", c("date").alias("eval_date"), "action", "fill_price",
            "realized_return_pct", "trigger_type", "exit_type"))
    if blocked is not None:
        stages.append(blocked.select(
            "ticker", c("date").alias("eval_date"), "block_reason", "intended_position_pct"))

    def attach(left: DataFrame, right: DataFrame) -> DataFrame:
        clash = [n for n in right.columns if n in left.columns and n not in KEYS]
        right = right.withColumnsRenamed({n: f"{n}_shadow" for n in clash})
        return left.join(right, KEYS, "left")

    return reduce(attach, stages, universe)


def scanner_lift(universe, scanner) -> DataFrame:
    m = resolved_universe(universe).join(scanner.select(*KEYS, "quant_filter_pass"), KEYS)
    passing = F.coalesce(F.col("quant_filter_pass") == 1, F.lit(False))
    row = m.agg(
        F.avg("return_5d").alias("__all"),
        F.avg(F.when(passing, F.col("return_5d"))).alias("__sel"),
        F.count("*").alias("n_universe"), F.count_if(passing).alias("n_passing"),
        *_counts(passing, F.col("beat_spy_5d")),
    )
    return binary_metrics(row).select(
        rnd("__all", 4).alias("universe_avg"), rnd("__sel", 4).alias("passing_avg"),
        rnd(F.col("__sel") - F.col("__all"), 4).alias("lift"), "n_universe", "n_passing", *RATES)


def _counts(selected, outcome):
    positive = F.when(outcome.isNotNull(), outcome == 1)
    return [c.alias(k) for k, c in binary_counts(selected, positive).items()]


def team_lift(universe, teams) -> DataFrame:
    """Per team: its picks against every stock of the picked sectors, and against
    its own candidates.  Sector sums are taken once over the universe, so the
    universe is never joined to itself row by row."""
    base = resolved_universe(universe)
    m = base.join(teams.select(*KEYS, "team_id", "team_recommended"), KEYS)
    pick = F.coalesce(F.col("team_recommended") == 1, F.lit(False))
    per_team = m.groupBy("team_id").agg(
        F.avg(F.when(pick, F.col("return_5d"))).alias("__pick"), F.avg("return_5d").alias("__quant"),
        F.count_if(pick).alias("n_picks"), F.count("*").alias("n_candidates"),
        *_counts(pick, F.col("beat_sector_5d")),
    )
    sectors = base.groupBy("sector").agg(F.sum("return_5d").alias("s"), F.count("return_5d").alias("c"))
    picked = m.filter(pick & F.col("sector").isNotNull()).select("team_id", "sector").distinct()
    baseline = picked.join(sectors, "sector").groupBy("team_id").agg(
        (F.sum("s") / F.sum("c")).alias("__sector"), F.sum("c").alias("n_sector_universe"))
    rows = per_team.join(baseline, "team_id", "left")
    return binary_metrics(rows).select(
        "team_id", rnd("__pick", 4).alias("pick_avg"), rnd("__sector", 4).alias("sector_avg"),
        rnd("__quant", 4).alias("quant_avg"),
        rnd(F.col("__pick") - F.col("__sector"), 4).alias("lift"),
        rnd(F.col("__pick") - F.col("__quant"), 4).alias("lift_vs_quant"),
        "n_picks", "n_candidates", F.coalesce("n_sector_universe", F.lit(0)).alias("n_sector_universe"),
        *RATES)


def committee_lift(universe, committee) -> DataFrame:
    m = resolved_universe(universe).join(committee.select(*KEYS, "cio_decision"), KEYS)
    advance = F.coalesce(F.col("cio_decision") == "ADVANCE", F.lit(False))
    reject = F.coalesce(F.col("cio_decision") == "REJECT", F.lit(False))
    row = m.agg(
        F.avg("return_5d").alias("__all"),
        F.avg(F.when(advance, F.col("return_5d"))).alias("__adv"),
        F.avg(F.when(reject, F.col("return_5d"))).alias("__rej"),
        F.count("*").alias("n_recs"), F.count_if(advance).alias("n_advance"),
        F.count_if(reject).alias("n_reject"), *_counts(advance, F.col("beat_spy_5d")),
    )
    return binary_metrics(row).select(
        rnd("__all", 4).alias("all_recs_avg"), rnd("__adv", 4).alias("advance_avg"),
        rnd("__rej", 4).alias("reject_avg"), rnd(F.col("__adv") - F.col("__all"), 4).alias("lift"),
        "n_recs", "n_advance", "n_reject", *RATES)


def committee_vs_ranking(universe, committee) -> DataFrame:
    """The committee's k picks of a date against the k best scores of that date.

    k differs per date.  Scores are first counted per (date, score), which keeps
    a crowded date small, and the score at which the k-th place falls is found
    from those counts; rows above it are all taken, and rows tied at it are
    ranked by ticker.
    """
    return ranking_of(resolved_universe(universe).join(committee.select(*KEYS, "cio_decision", "final_score"), KEYS))


def ranking_of(resolved: DataFrame) -> DataFrame:
    """``committee_vs_ranking`` where the committee's rows carry their outcome already."""
    m = resolved.select(*KEYS, "return_5d", "final_score", F.coalesce(F.col("cio_decision") == "ADVANCE", F.lit(False)).alias("advance"))
    day = Window.partitionBy("eval_date")
    above = day.orderBy(F.col("final_score").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        m.groupBy("eval_date", "final_score").agg(
            F.count("*").alias("cnt"), F.count_if("advance").alias("picks"),
            F.sum(F.when(F.col("advance"), F.col("return_5d"))).alias("pick_sum"))
        .withColumns({"k": F.sum("picks").over(day), "pick_sum": F.sum("pick_sum").over(day),
                      "above": F.coalesce(F.sum("cnt").over(above), F.lit(0))})
        .filter(F.col("final_score").isNotNull() & (F.col("above") < F.col("k")))
        .select("eval_date", F.col("final_score").alias("__score"), "k", (F.col("pick_sum") / F.col("k")).alias("cio_avg"),
                F.least(F.col("cnt"), F.col("k") - F.col("above")).alias("free"), "cnt")
    )
    # null-safe, so that the rows of both uses of m are filtered alike and shuffled once
    contenders = m.join(placed.withColumnRenamed("eval_date", "__day"), [
        m["eval_date"].eqNullSafe(F.col("__day")), m["final_score"].eqNullSafe(F.col("__score"))])
    # where all rows of a score are taken, each is ranked alone
    alone = F.when(F.col("free") == F.col("cnt"), F.col("ticker"))
    tied = Window.partitionBy("eval_date", "final_score", alone).orderBy("ticker")
    dates = (
        contenders.withColumn("__r", F.row_number().over(tied))
        .filter((F.col("__r") <= F.col("free")) | alone.isNotNull())
        .groupBy("eval_date").agg(
            F.max("k").alias("k"), F.max("cio_avg").alias("cio_avg"),
            F.avg("return_5d").alias("ranking_avg"), F.count_if("advance").alias("overlap"))
    )
    row = dates.agg(
        rnd(F.avg("cio_avg"), 4).alias("cio_avg"), rnd(F.avg("ranking_avg"), 4).alias("ranking_avg"),
        rnd(F.avg("overlap"), 4).alias("avg_overlap"), F.count("*").alias("n_dates"),
        F.sum("k").alias("n_picks"))
    return row.withColumn("lift", rnd(F.col("cio_avg") - F.col("ranking_avg"), 4)).withColumn(
        "cio_beats_ranking", F.col("lift") > 0)


def predictor_lift(universe, predictions) -> DataFrame:
    po = predictions.select(F.col("symbol").alias("ticker"), F.col("prediction_date").alias("eval_date"),
                            "predicted_direction")
    m = resolved_universe(universe).join(po, KEYS)
    up = F.coalesce(F.col("predicted_direction") == "UP", F.lit(False))
    down = F.coalesce(F.col("predicted_direction") == "DOWN", F.lit(False))
    row = m.agg(
        F.avg("return_5d").alias("__all"), F.avg(F.when(up, F.col("return_5d"))).alias("__up"),
        F.avg(F.when(down, F.col("return_5d"))).alias("__down"), F.count("*").alias("n_all"),
        F.count_if(up).alias("n_up"), F.count_if(down).alias("n_down"),
        *_counts(up, F.col("beat_spy_5d")),
    )
    return binary_metrics(row).select(
        rnd("__all", 4).alias("all_avg"), rnd("__up", 4).alias("up_avg"),
        rnd("__down", 4).alias("down_avg"), rnd(F.col("__up") - F.col("__all"), 4).alias("lift"),
        "n_all", "n_up", "n_down", *RATES)


def executor_lift(universe, trades, blocked) -> DataFrame:
    """Traded entries against traded and blocked together.  The outcome of a
    blocked row that was traded as well counts as selected."""
    base = resolved_universe(universe).select(*KEYS, "return_5d", "beat_spy_5d")
    t = trades.filter(F.col("action") == "ENTER").select("ticker", F.col("date").alias("eval_date"))
    b = blocked.select("ticker", F.col("date").alias("eval_date"))
    traded_keys = t.distinct().withColumn("__was_traded", F.lit(True))
    traded = base.join(t, KEYS).withColumn("__traded", F.lit(True)).withColumn("selected", F.lit(True))
    held = (
        base.join(b, KEYS).join(traded_keys, KEYS, "left")
        .withColumn("__traded", F.lit(False))
        .withColumn("selected", F.coalesce("__was_traded", F.lit(False))).drop("__was_traded")
    )
    approved = traded.unionByName(held)
    row = approved.agg(
        F.avg(F.when(F.col("__traded"), F.col("return_5d"))).alias("__t"),
        F.avg("return_5d").alias("__a"), F.count_if("__traded").alias("n_traded"),
        F.count("*").alias("n_approved"), *_counts(F.col("selected"), F.col("beat_spy_5d")),
    )
    return binary_metrics(row).select(
        rnd("__t", 4).alias("traded_avg"), rnd("__a", 4).alias("approved_avg"),
        rnd(F.col("__t") - F.col("__a"), 4).alias("lift"), "n_traded", "n_approved", *RATES)


def pipeline_lift(universe, executor_row: DataFrame, committee_row: DataFrame) -> DataFrame:
    """What was traded (else what the committee advanced) against the universe."""
    u = resolved_universe(universe).agg(F.avg("return_5d").alias("__u"))
    row = with_scalars(executor_row.select("traded_avg"), committee_row.select("advance_avg"), u).select(F.coalesce("traded_avg", "advance_avg").alias("traded_avg"), "__u")
    return row.select(rnd("__u", 4).alias("universe_avg"), "traded_avg",
                      rnd(F.col("traded_avg") - F.col("__u"), 4).alias("lift"))


def stage_rows(universe, scanner=None, teams=None, committee=None, predictions=None, trades=None, blocked=None) -> DataFrame:
    """One keyed union of the universe (stage ``universe``) and every stage given, each row with its outcome.

    ``selected`` is the stage's choice, ``other`` its second one: rejected, DOWN, or traded for the executor.  All rows
    of a (ticker, eval_date) meet in one shuffle; the outcome of the universe, one row per key, and whether the key was
    traded are handed to them there.  Rows without a resolved outcome are dropped.
    """
    no = F.lit(False)

    def part(df, name, selected=no, other=no, ticker="ticker", day="eval_date", **own):
        return df.select(F.col(ticker).alias("ticker"), F.col(day).alias("eval_date"), F.lit(name).alias("stage"),
                         F.coalesce(selected, no).alias("selected"), F.coalesce(other, no).alias("other"),
                         *[F.col(c).alias(n) for n, c in own.items()])

    c = F.col
    outcome = ["return_5d", "beat_spy_5d", "beat_sector_5d", "sector"]
    parts = [part(resolved_universe(universe), "universe", **{n: n for n in outcome})]
    if scanner is not None:
        parts.append(part(scanner, "scanner", c("quant_filter_pass") == 1))
    if teams is not None:
        parts.append(part(teams, "teams", c("team_recommended") == 1, team_id="team_id"))
    if committee is not None:
        parts.append(part(committee, "committee", c("cio_decision") == "ADVANCE", c("cio_decision") == "REJECT"))
    if predictions is not None:
        parts.append(part(predictions, "predictor", c("predicted_direction") == "UP", c("predicted_direction") == "DOWN",
                          "symbol", "prediction_date"))
    if trades is not None:
        parts.append(part(trades.filter(c("action") == "ENTER"), "executor", F.lit(True), F.lit(True), day="date"))
    if blocked is not None:
        parts.append(part(blocked, "executor", day="date"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if teams is None:
        rows = rows.withColumn("team_id", F.lit(None).cast("string"))
    key = Window.partitionBy(*KEYS)
    was_traded = F.max((c("stage") == "executor") & c("other")).over(key)
    return rows.withColumns({
        **{n: F.max(n).over(key) for n in outcome},
        "selected": c("selected") | ((c("stage") == "executor") & was_traded)}).filter(c("return_5d").isNotNull())


def research_rows(universe, scanner, teams, committee) -> DataFrame:
    """The rows of three stages, each with the outcome of its (ticker, eval_date) or NULLs: one join for all that reads them.

    The ticker is kept for the committee alone, whose ties it breaks.
    """
    c = F.col
    own = {
        "scanner": scanner.select(*KEYS, "quant_filter_pass", (c("quant_filter_pass") == 1).alias("selected")),
        "teams": teams.select(*KEYS, "team_id", (c("team_recommended") == 1).alias("selected")),
        "committee": committee.select(
            *KEYS, "cio_decision", "combined_score", "final_score", "macro_shift",
            (c("cio_decision") == "ADVANCE").alias("selected"), (c("cio_decision") == "REJECT").alias("other")),
    }
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [df.withColumn("stage", F.lit(name)) for name, df in own.items()])
    no = F.lit(False)
    outcome = universe.select(*KEYS, "sector", "return_5d", "spy_return_5d", "beat_spy_5d", "beat_sector_5d")
    return rows.join(outcome, KEYS, "left").withColumns({
        "ticker": F.when(c("stage") == "committee", c("ticker")),
        "selected": F.coalesce("selected", no), "other": F.coalesce("other", no)})


def research_stage_rows(universe, rows: DataFrame) -> DataFrame:
    """``stage_rows`` from ``research_rows``; the universe's own rows are not shuffled."""
    columns = ["stage", "team_id", "sector", "return_5d", "beat_spy_5d", "beat_sector_5d", "selected", "other"]
    whole = resolved_universe(universe).withColumns({
        "stage": F.lit("universe"), "team_id": F.lit(None).cast("string"), "selected": F.lit(False), "other": F.lit(False)})
    return whole.select(columns).unionByName(resolved_universe(rows).select(columns))


def stage_metrics(rows: DataFrame) -> DataFrame:
    """(stage, team_id) with means, lifts, counts and rates; teams in a row each, other stages in one.

    ``rows`` are aggregated once, per stage, team and sector; what a team's picks are held against, the stocks of the
    picked sectors, is in the same small table.
    """
    c = F.col
    outcome = F.when(c("stage") == "teams", c("beat_sector_5d")).otherwise(c("beat_spy_5d"))
    cube = rows.groupBy("stage", "team_id", "sector").agg(
        F.count("*").alias("rows"), F.sum("return_5d").alias("total"),
        *[a for n in ("selected", "other") for a in (
            F.count_if(n).alias(f"n_{n}"), F.sum(F.when(c(n), c("return_5d"))).alias(f"sum_{n}"))],
        *_counts(c("selected"), outcome))
    # from here on a row per stage, team and sector
    sector = Window.partitionBy("sector")
    universe = lambda n: F.max(F.when(c("stage") == "universe", c(n))).over(sector)
    picked = (c("stage") == "teams") & (c("n_selected") > 0) & c("sector").isNotNull()
    per_team = (
        cube.withColumns({"sector_total": universe("total"), "sector_rows": universe("rows")})
        .groupBy("stage", "team_id").agg(
            *[F.sum(n).alias(n) for n in ("rows", "total", "n_selected", "sum_selected", "n_other", "sum_other", "tp", "fp", "fn", "tn")],
            *[F.sum(F.when(picked, c(n))).alias(n) for n in ("sector_total", "sector_rows")])
    )
    mean = lambda s, n: F.try_divide(c(s), c(n))
    executor = c("stage") == "executor"
    per_team = binary_metrics(per_team).withColumns({
        "__all": mean("total", "rows"), "__other": mean("sum_other", "n_other"),
        "__mean": F.when(executor, mean("sum_other", "n_other")).otherwise(mean("sum_selected", "n_selected")),
    }).withColumn("__base", F.when(c("stage") == "teams", mean("sector_total", "sector_rows")).otherwise(c("__all")))
    return per_team.select(
        "stage", "team_id", rnd("__mean", 4).alias("mean"), rnd("__base", 4).alias("baseline"), "__all",
        rnd(c("__mean") - c("__base"), 4).alias("lift"), rnd(c("__mean") - c("__all"), 4).alias("lift_vs_all"),
        (rnd("__mean", 4) - rnd("__other", 4)).alias("spread"),
        F.when(executor, c("n_other")).otherwise(c("n_selected")).alias("n_selected"), c("rows").alias("n_rows"), *RATES)


def lift_summary(universe, scanner, teams, committee, predictions, trades, blocked) -> DataFrame:
    """One row per stage; teams appear with the mean over teams.

    All stages but the ranking are one pass (``stage_rows``); stages without a row keep theirs, with NULLs.
    """
    c = F.col
    rates = ["precision", "recall", "f1"]
    metrics = stage_metrics(stage_rows(universe, scanner, teams, committee, predictions, trades, blocked))
    stages = metrics.groupBy("stage").agg(
        *[rnd(F.avg(n), 4).alias(n) for n in ("mean", "baseline", "lift", *rates)],
        F.max("__all").alias("__all"), F.sum("n_selected").alias("n_selected"))
    names = ["scanner", "teams", "committee", "predictor", "executor", "pipeline"]
    spine = universe.sparkSession.createDataFrame([(n,) for n in names], "name string")
    source = F.when(c("name") == "pipeline", "universe").otherwise(c("name"))
    rows = spine.join(F.broadcast(stages), source == c("stage"), "left")  # seven rows at most
    of = lambda n: F.max(F.when(c("name") == n, c("mean"))).over(Window.partitionBy(F.lit(0)))
    pipe = c("name") == "pipeline"
    rows = rows.withColumn("mean", F.when(pipe, F.coalesce(of("executor"), of("committee"))).otherwise(c("mean"))).select(
        c("name").alias("stage"), "mean", F.when(pipe, rnd("__all", 4)).otherwise(c("baseline")).alias("baseline"),
        F.when(pipe, rnd(c("mean") - c("__all"), 4)).otherwise(c("lift")).alias("lift"),
        F.when(c("name") == "teams", c("n_selected")).when(~pipe, F.coalesce("n_selected", F.lit(0))).alias("n_selected"),
        *[F.when(~pipe, c(n)).alias(n) for n in rates])
    none = F.lit(None).cast("double")
    rank = committee_vs_ranking(universe, committee).select(
        F.lit("committee_vs_ranking").alias("stage"), c("cio_avg").alias("mean"), c("ranking_avg").alias("baseline"),
        "lift", c("n_picks").alias("n_selected"), *[none.alias(n) for n in rates])
    return rows.unionByName(rank)
