"""Stages that meet their outcome in one join give what each operator gives with a join of its own."""

import pytest

from assay.operators import lift as L
from assay.operators import predictor as P
from assay.plans import views as V
from tests.conftest import rows

DAYS = [f"2024-01-{d:02d}" for d in range(1, 11)]


@pytest.fixture
def research(table):
    """Ten days of six tickers; repeated stage rows, unknown tickers and keys, NULL flags, scores and returns."""
    universe, scanner, teams, committee = [], [], [], []
    for d, day in enumerate(DAYS):
        for i, n in enumerate("ABCDEF"):
            ret = None if (i + d) % 7 == 0 else float((i * 7 + d * 3) % 11 - 4)
            beat = None if ret is None else int((i + d) % 3 > 0)
            universe.append((n, day, None if i == 5 else "st"[i % 2], ret, 0.5, beat, beat))
            scanner.append((n, day, None if i == 4 else (i + d) % 2))
            teams.append((n, day, "t1" if i < 3 else "t2", int(i % 3 == 0)))
            committee.append((n, day, ("ADVANCE", "REJECT", None)[(i + d) % 3], 55.0 + 2 * i, None if i == 2 else 57.0 + (i + d) % 5, float(i % 3 - 1)))
    scanner += [("Z", DAYS[0], 0), ("A", None, 0), ("A", DAYS[0], 0)]
    committee += [("Z", DAYS[1], "ADVANCE", 70.0, 70.0, 0.0), ("B", DAYS[1], "ADVANCE", 61.0, 60.0, -1.0)]
    return (
        table("ticker string, eval_date date, sector string, return_5d double, spy_return_5d double, beat_spy_5d int, beat_sector_5d int", universe),
        table("ticker string, eval_date date, quant_filter_pass int", scanner),
        table("ticker string, eval_date date, team_id string, team_recommended int", teams),
        table("ticker string, eval_date date, cio_decision string, combined_score double, final_score double, macro_shift double", committee))


def test_one_join_agrees_with_each_operator_alone(research):
    universe, scanner, teams, committee = research
    joined = L.research_rows(*research)
    assert joined.count() == scanner.count() + teams.count() + committee.count()
    scanned, advised = joined.filter("stage = 'scanner'"), L.resolved_universe(joined.filter("stage = 'committee'"))
    assert rows(P.leakage_of(scanned, scanned)) == rows(P.scanner_leakage(scanner, universe)) != []
    assert rows(P.macro_of(advised)) == rows(P.macro_evaluation(committee, universe)) != []
    assert rows(L.ranking_of(advised)) == rows(L.committee_vs_ranking(universe, committee)) != []
    got = L.stage_metrics(L.research_stage_rows(universe, joined))
    want = L.stage_metrics(L.stage_rows(universe, scanner, teams, committee))
    assert sorted(got.columns) == sorted(want.columns) and rows(got, *want.columns) == rows(want) != []


def test_outcomes_are_joined_once_and_without_a_window(research):
    text = L.research_rows(*research)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Join") == 1 and "Window" not in text
    assert L.research_stage_rows(research[0], L.research_rows(*research))._jdf.queryExecution().executedPlan().toString().count("Window") == 0


@pytest.mark.parametrize("name", sorted(V.COMPARED))
def test_aggregates_of_compared_letters_do_not_sort(spark, name):
    text = V.Tables(spark, "/root/testdata/sf0.001")._view(name)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_letters_that_are_put_back_compare_as_before(spark):
    lines = [(k, f) for k, fs in enumerate((["A", "R"], ["R", "S"], ["A", "N"], [None, "R"], [None, None], ["R", "R2"], ["", "Q"])) for f in fs]
    spark.createDataFrame(lines, "k int, l_returnflag string").createOrReplaceTempView("compared_flags")
    was, now = V.COMPARED["cells"]
    got = spark.sql(f"SELECT k, coalesce({was} = 'R', false) AS a, coalesce({now} = 'R', false) AS b FROM compared_flags GROUP BY k").collect()
    assert len(got) == 7 and all(x.a == x.b for x in got) and {x.k for x in got if x.a} == {0, 3}
