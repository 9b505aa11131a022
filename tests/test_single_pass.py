"""Results that come from one pass agree with the operators that take each part alone."""

import pytest

from assay.operators import grading as G
from assay.operators import lift as L
from tests.conftest import rows

DAYS = ("2024-01-02", "2024-01-03")


@pytest.fixture
def stages(table):
    """Two days of eight tickers; repeated stage rows, unknown tickers, NULL flags and NULL scores."""
    names = "ABCDEFGH"
    universe, scanner, teams, committee, predictions, trades, blocked = ([] for _ in range(7))
    for d, day in enumerate(DAYS):
        for i, n in enumerate(names):
            ret = None if (i, d) == (7, 0) else float((i * 7 + d * 3) % 11 - 4)
            universe.append((n, day, None if i == 6 else "st"[i % 2], ret, None if i == 5 else int((i + d) % 3 > 0), i % 2))
            scanner.append((n, day, None if i == 4 else i % 2))
            if i < 6:
                teams.append((n, day, "t1" if i < 4 else "t2", int(i % 3 == 0)))
                committee.append((n, day, ("ADVANCE", "REJECT", None)[(i + d) % 3], None if i == 2 else 10.0 - i // 2))
            predictions.append((n, day, ("UP", "DOWN", "FLAT")[i % 3]))
            if i in (0, 1):
                trades.append((n, day, "ENTER"))
            if i in (1, 3):
                blocked.append((n, day))
    scanner.append(("Z", DAYS[0], 1))
    committee.append(("A", DAYS[0], "ADVANCE", 10.0))
    trades += [("A", DAYS[0], "ENTER"), ("C", DAYS[0], "EXIT")]
    return (
        table("ticker string, eval_date date, sector string, return_5d double, beat_spy_5d int, beat_sector_5d int", universe),
        table("ticker string, eval_date date, quant_filter_pass int", scanner),
        table("ticker string, eval_date date, team_id string, team_recommended int", teams),
        table("ticker string, eval_date date, cio_decision string, final_score double", committee),
        table("symbol string, prediction_date date, predicted_direction string", predictions),
        table("ticker string, date date, action string", trades), table("ticker string, date date", blocked))


def test_stage_metrics_agree_with_each_stage_alone(stages):
    u, scanner, teams, committee, predictions, trades, blocked = stages
    got = {(r.stage, r.team_id): r for r in L.stage_metrics(L.stage_rows(*stages)).collect()}

    def check(key, row, mean, base, n):
        g = got[key]
        assert (g["mean"], g.baseline, g.lift, g.n_selected) == pytest.approx((row[mean], row[base], row["lift"], row[n]))
        assert tuple(g[c] for c in L.RATES) == tuple(row[c] for c in L.RATES), key

    check(("scanner", None), L.scanner_lift(u, scanner).first(), "passing_avg", "universe_avg", "n_passing")
    cio = L.committee_lift(u, committee).first()
    check(("committee", None), cio, "advance_avg", "all_recs_avg", "n_advance")
    assert got["committee", None].spread == pytest.approx(cio.advance_avg - cio.reject_avg)
    check(("predictor", None), L.predictor_lift(u, predictions).first(), "up_avg", "all_avg", "n_up")
    check(("executor", None), L.executor_lift(u, trades, blocked).first(), "traded_avg", "approved_avg", "n_traded")
    per_team = L.team_lift(u, teams).collect()
    assert len(per_team) == 2
    for row in per_team:
        check(("teams", row.team_id), row, "pick_avg", "sector_avg", "n_picks")
        assert got["teams", row.team_id].lift_vs_all == pytest.approx(row.lift_vs_quant)


def test_summary_keeps_stages_without_rows_and_falls_back_to_the_committee(stages):
    u, scanner, teams, committee, predictions, trades, blocked = stages
    got = {r.stage: r for r in L.lift_summary(u, scanner, teams, committee, predictions, trades.limit(0), blocked.limit(0)).collect()}
    assert sorted(got) == sorted(["scanner", "teams", "committee", "committee_vs_ranking", "predictor", "executor", "pipeline"])
    assert (got["executor"]["mean"], got["executor"].n_selected) == (None, 0)
    assert got["pipeline"]["mean"] == got["committee"]["mean"] and got["pipeline"].n_selected is None


def test_ranking_takes_ties_by_ticker_and_counts_picks_without_score(table):
    u = table("ticker string, eval_date date, return_5d double", [(n, DAYS[0], v) for n, v in zip("ABCD", (1, 2, 4, 8))])
    c = table("ticker string, eval_date date, cio_decision string, final_score double", [
        ("A", DAYS[0], "ADVANCE", None), ("B", DAYS[0], "ADVANCE", 5), ("C", DAYS[0], "REJECT", 5), ("D", DAYS[0], "REJECT", 9)])
    r = L.committee_vs_ranking(u, c).first()
    # two picks (A, B); the two best scores are D, and B before C
    assert (r.cio_avg, r.ranking_avg, r.avg_overlap, r.n_dates, r.n_picks) == (1.5, 5.0, 1.0, 1, 2)


def test_grades_choose_the_rule_set_in_one_aggregate(table):
    metrics = table("component string, item string, metric string, value double", [
        ("veto_gate", "", "precision", 0.8), ("veto_gate", "", "recall", None), ("veto_gate", "", "lift", 20.0),
        ("team", "x", "precision", 0.7), ("team", "x", "recall", 0.5), ("macro", "", "alpha_lift", None)])
    got = {(r.component, r.item): (r.grade, r.letter) for r in G.component_grades(metrics).collect()}
    assert got == {("veto_gate", ""): (97.142857, "A"), ("team", "x"): (95.0, "A"), ("macro", ""): (None, "N/A")}
    card = rows(G.scorecard(G.component_means(G.component_grades(metrics))), "level", "name", "grade", "status")
    assert card == sorted([
        ("module", "research", 95.0, None), ("module", "predictor", 97.142857, None), ("module", "executor", None, None),
        ("overall", "overall", 95.824176, "partial")], key=repr)


def test_every_stage_is_read_once(stages):
    plan = L.stage_metrics(L.stage_rows(*stages))._jdf.queryExecution().executedPlan().toString()
    # rows by key, then the small tables: per stage, team and sector; per sector; per stage and team
    assert plan.count("Scan ExistingRDD") == len(stages) and plan.count("Exchange hashpartitioning") <= 4
    assert "Join" not in plan
