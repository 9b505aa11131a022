"""Correlations of candidates with held names, by blocks of days: against numpy, pair by pair."""

import numpy as np
import pytest

from assay.operators import portfolio as PF

SCHEMA = "ticker string, block bigint, sector string, held array<struct<holders:array<int>,days:bigint>>, days bigint, asked bigint, known array<struct<place:int,ret:double>>"


@pytest.fixture(scope="module")
def case(spark):
    """Nine tickers of two sectors over two blocks; one has no returns, one a constant one, some are held and asked."""
    rng = np.random.default_rng(3)
    rets = {f"S{k}": {p: float(rng.normal()) for p in range(120) if rng.random() < 0.6} for k in range(9)}
    rets["S3"], rets["S4"] = {}, {p: 0.01 for p in range(120)}
    sector = {k: "xy"[i % 2 if i < 8 else 0] for i, k in enumerate(rets)}
    held = {(c, k, p) for c in (1, 4) for k in rets for p in range(1, 120) if rng.random() < 0.2}
    asked = {(k, p) for k in rets for p in (1, 2, 5, 59, 60, 61, 90, 119)}
    rows = []
    for k in rets:
        for block in (0, 1):
            sets = {}
            for p in range(block * 60, block * 60 + 60):
                who = tuple(c for c in (1, 4) if (c, k, p) in held)
                if who:
                    sets[who] = sets.get(who, 0) | 1 << (p - block * 60)
            known = [(p - block * 60 + 60, v) for p, v in rets[k].items() if 0 <= p - block * 60 + 60 < 119] or None
            days = 0
            for v in sets.values():
                days |= v
            rows.append((k, block, sector[k], [(list(w), v) for w, v in sets.items()], days,
                         sum(1 << (p - block * 60) for q, p in asked if q == k and p // 60 == block), known))
    blocks = spark.createDataFrame(rows, SCHEMA)

    def corr(a, b, p):
        x, y = ([rets[k].get(i, 0.0) for i in range(max(0, p - 60), p)] for k in (a, b))
        if len(x) < 2 or np.std(x, ddof=1) <= 1e-9 or np.std(y, ddof=1) <= 1e-9:
            return None
        return float(np.corrcoef(x, y)[0, 1])

    return blocks, sector, held, asked, corr


def test_pairs_of_a_block(case, monkeypatch):
    blocks, sector, held, asked, corr = case
    monkeypatch.setattr(PF, "PAIRS", 3)
    found = [tuple(r) for r in PF.block_pairs(blocks, parts=4).collect()]
    by_any = {(k, p) for _, k, p in held}
    expected = {(p, a, b) for a, p in asked for b, q in by_any if q == p and a != b and sector[a] == sector[b]}
    assert len(found) == len(expected) and {r[:3] for r in found} == expected
    for p, a, b, n, c in found:
        want = corr(a, b, p)
        assert n == min(p, 60) and (c is None) == (want is None) and (c is None or abs(c - want) < 1e-9)


def test_means_of_a_block(case):
    blocks, sector, held, asked, corr = case
    found = {(r.pos, r.ticker, c): m for r in PF.block_means(blocks, parts=4).collect() for c, m in r.means.items()}
    expected = {}
    for a, p in asked:
        for c in (1, 4):
            names = [k for d, k, q in held if (d, q) == (c, p) and k != a and sector[k] == sector[a]]
            if names:
                expected[p, a, c] = sum(corr(a, k, p) or 0.0 for k in names) / len(names)
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-9 for k in expected)


def test_no_row_per_pair_or_held_day_is_shuffled(spark):
    """Pairs and days are made where the tickers of a sector met: the plan has no join or shuffle above that."""
    import __spark_entry__ as entry

    plan = entry.queries()["pair_correlations"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("FlatMapGroupsInArrow")[0]
    assert "FlatMapGroupsInArrow" in plan and "Join" not in above and "Repartition" not in above


def test_rows_of_a_block_are_sent_once(case):
    """Copies of the held names for several tasks of a sector filled the disks."""
    plan = PF.block_pairs(case[0])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "RepartitionByExpression [sector" in plan
