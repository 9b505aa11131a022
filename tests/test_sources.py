import json

import pytest
from pyspark.sql import functions as F

from assay.sources import documents as DOC
from assay.sources import tables as TB
from assay.sources.schemas import TRADES, conform
from tests.conftest import rows

ENTRY = {"ticker": "A", "signal": "ENTER", "score": 80, "conviction": "rising", "sector": "X"}


def docs(spark, *bodies, day="2024-01-02"):
    data = [(i, day, f"signals/{day}/signals.json", b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(data, "doc_id int, doc_date string, path string, body string").withColumn("doc_date", F.to_date("doc_date"))


def test_map_and_list_forms(spark):
    d = DOC.parse_signals(docs(
        spark, {"signals": {"A": {"rating": "BUY", "score": 71}, "B": {"rating": "BUY"}}},
        {"signals": [{"ticker": "C", "rating": "BUY", "score": 70}, {"ticker": "D", "rating": "HOLD", "score": 99}]}))
    assert rows(DOC.buy_signals(d).select("ticker")) == [("A",), ("B",), ("C",)]
    assert rows(DOC.buy_signals(d, 70.5).select("ticker")) == [("A",)]
    assert rows(DOC.referenced_tickers(d).select("ticker")) == [("A",), ("B",), ("C",), ("D",)]


def test_bad_documents_are_set_aside(spark):
    d = DOC.parse_signals(docs(spark, {"universe": [ENTRY]}, {"date": "x"}, {"signals": {}}, "not json"))
    assert rows(DOC.valid_documents(d).select("doc_id")) == [(0,)]
    assert DOC.rejected_documents(d).count() == 3


def test_path_dates(spark):
    df = spark.createDataFrame([("a/2024-01-31/x.json",), ("a/2024-02-31/x.json",), ("a/latest/x.json",)], "path string")
    assert [str(r[0]) for r in df.select(DOC.path_date()).collect()] == ["2024-01-31", "None", "None"]


def test_flatten_and_rebuild(spark):
    body = {"market_regime": "bull", "sector_ratings": {"X": {"rating": "overweight", "modifier": 1.1}},
            "buy_candidates": [ENTRY, {**ENTRY, "ticker": "B"}], "universe": [{**ENTRY, "ticker": "C", "signal": "HOLD", "score": None}]}
    p = DOC.parse_signals(docs(spark, body, {"universe": []}))
    rec = DOC.flat_records(p)
    assert rows(rec.select("bucket", "position", "ticker", "score")) == [("buy", 0, "A", 80.0), ("buy", 1, "B", 80.0), ("universe", 0, "C", 0.0)]
    back = {r["doc_id"]: r for r in DOC.rebuild_documents(rec, DOC.flat_metadata(p)).collect()}
    assert [e["ticker"] for e in back[0]["buy_candidates"]] == ["A", "B"] and back[0]["sector_ratings"]["X"]["modifier"] == 1.1
    assert back[1]["market_regime"] == "neutral" and back[1]["universe"] is None


def test_segmentation_and_lookup(spark):
    body = {"buy_candidates": [{**ENTRY, "sector": "late"}], "universe": [{**ENTRY, "signal": "EXIT", "sector": "early"}, {**ENTRY, "ticker": "q"}]}
    rec = DOC.flat_records(DOC.parse_signals(docs(spark, body)))
    assert rows(DOC.actionable(rec).select("ticker", "signal")) == [("A", "ENTER"), ("q", "ENTER")]
    assert rows(DOC.signal_lookup(rec).filter("ticker = 'A'").select("signal", "sector")) == [("EXIT", "late")]
    known = spark.createDataFrame([("A",), ("Q",)], "ticker string")
    assert DOC.filter_to_universe(rec, known).count() == 3  # upper-cased before the look-up
    assert rows(DOC.rejected_tickers(rec, known.filter("ticker = 'A'"))) == [("Q", 1)]


def test_sub_score_fallbacks(spark):
    u = [{"ticker": "n", "sub_scores": {"quant": 1, "qual": None}, "quant_score": 9}, {"ticker": "f", "quant_score": None, "qual_score": 4},
         {"ticker": "l", "sub_scores": {"technical": 5, "news": 2, "research": 4}}, {"ticker": "o", "sub_scores": {"technical": 5}},
         {"ticker": "x", "sub_scores": {"news": 1}}, {"ticker": "m", "quant_score": 1}]
    p = DOC.parse_signals(docs(spark, {"universe": u, "signals": {"m": {"quant_score": 7}}}))
    assert rows(DOC.sub_scores(p).select("symbol", "quant_score", "qual_score")) == [
        ("f", None, 4.0), ("l", 5.0, 3.0), ("m", 7.0, None), ("n", 1.0, None), ("o", 5.0, None)]


def test_predictions_skip_latest_and_unnamed(spark):
    body = json.dumps({"predictions": [{"ticker": "A", "predicted_direction": "UP"}, {"ticker": None}]})
    d = spark.createDataFrame([(1, "p/2024-01-02.json", body), (2, "p/latest.json", body)], "doc_id int, path string, body string")
    got = DOC.predictions(d).collect()
    assert len(got) == 1 and got[0]["prediction_confidence"] == 0.0 and str(got[0]["date"]) == "2024-01-02"


def test_opening_positions(table):
    snap = table("account string, snapshot_id int, date date, portfolio_nav double, total_cash double, positions_snapshot string", [
        ("a", 1, "2024-01-01", 500, 10, '{"T": {"shares": 5, "avg_cost": 2.5}, "Z": {"shares": 0}}'), ("a", 2, "2024-01-02", 90, 10, "{}"),
        ("a", 3, "2024-01-03", 80, None, '{"T": {"shares": 9}}'), ("b", 4, "2024-01-09", 70, 7, '{"U": {"shares": 1}}'), ("b", 5, "2024-01-10", 99, 7, '{"U": {"shares": 2}}')])
    trades = table("ticker string, date date, action string", [("T", "2023-12-01", "ENTER"), ("T", "2024-01-02", "ENTER"), ("T", "2023-12-20", "EXIT")])
    got = rows(DOC.snapshot_asof(snap, trades, "2024-01-05").select(
        "account", F.col("as_of").cast("string"), "peak_nav", "ticker", "shares", F.col("entry_date").cast("string")))
    assert got == [("a", "2024-01-01", 500.0, "T", 5, "2023-12-01"), ("b", "2024-01-09", 70.0, "U", 1, "2024-01-09")]


def test_read_documents_from_files(spark, tmp_path):
    (tmp_path / "2024-01-02").mkdir()
    (tmp_path / "2024-01-02" / "signals.json").write_text(json.dumps({"universe": [ENTRY]}, indent=2))
    d = DOC.read_documents(spark, str(tmp_path / "*" / "*.json"))
    assert rows(DOC.document_dates(d).select(F.col("date").cast("string"))) == [("2024-01-02",)]
    p = DOC.parse_signals(d.withColumns({"doc_id": F.lit(1), "doc_date": DOC.path_date()}))
    assert DOC.flat_records(p).first()["ticker"] == "A"


def test_unify_frames(table):
    a = table("x int, s string", [(1, "u")])
    b = table("y double, x double", [(2.0, 1.5)])
    u = TB.unify([a, b])
    assert u.columns == ["x", "s", "y"] and dict(u.dtypes)["x"] == "double"
    assert rows(u) == [(1.0, "u", None), (1.5, None, 2.0)]
    with pytest.raises(TypeError, match="column s"):
        TB.unify([a, table("s int", [(1,)])])


def test_conform_adds_columns_and_drops_nan(table):
    d = conform(table("ticker string, fill_price double, other int", [("a", float("nan"), 1)]), TRADES)
    assert len(d.columns) == 24 and d.first()["fill_price"] is None and d.first()["ticker"] == "a"


def test_missing_table_is_empty(spark):
    assert TB.scan_or_empty(spark, "no_such_table", TRADES).count() == 0


def test_upsert_keeps_latest_dates(table):
    h = table("date date, g int", [(f"2024-01-{d:02d}", d) for d in range(1, 11)])
    new = table("date date, g int, extra string", [("2024-01-10", 99, "n"), ("2024-01-11", 100, "n")])
    got = rows(TB.upsert_by_date(h, new, keep=3).select("g", "extra"))
    assert got == [(100, "n"), (9, None), (99, "n")]
    once = TB.append_once(h.withColumnRenamed("date", "run_date"), new.withColumnRenamed("date", "run_date"))
    assert once.count() == 11 and TB.append_once(once, new.withColumnRenamed("date", "run_date")).count() == 11


def test_rerun_replaces_one_partition(table, spark, tmp_path):
    out = str(tmp_path / "t")
    TB.write_table(table("run_date string, v int", [("a", 1), ("b", 2)]), out, by=["run_date"])
    TB.write_table(table("run_date string, v int", [("b", 3)]), out, by=["run_date"])
    assert rows(TB.read_table(spark, out, ["v"]).select("run_date", "v")) == [("a", 1), ("b", 3)]
    with pytest.raises(ValueError, match="lacks"):
        TB.read_table(spark, out, ["w"])


def test_exports(table, spark, tmp_path):
    df = table("a int, b string", [(1, "x")])
    TB.export_result(df, str(tmp_path / "c"), "csv")
    TB.export_result(df, str(tmp_path / "j"), "json")
    assert spark.read.csv(str(tmp_path / "c"), header=True).first()["b"] == "x"
    assert spark.read.json(str(tmp_path / "j")).first()["a"] == 1
    TB.export_run({"stats": df}, str(tmp_path / "r"), "2024-01-02")
    assert str(spark.read.parquet(str(tmp_path / "r" / "stats")).first()["run_date"]) == "2024-01-02"


def test_clustered_write_and_series(table, spark, tmp_path):
    wide = table("date date, a double, b double", [("2024-01-01", 1, None), ("2024-01-02", 2, 3)])
    s = TB.stack_series(wide, "date")
    TB.write_table(s, str(tmp_path / "s"), cluster="ticker")
    assert rows(TB.series_of(TB.read_table(spark, str(tmp_path / "s")), "b").select("value")) == [(3.0,)]


def test_latest_rows(table):
    d = table("k string, t int, v int", [("a", 1, 1), ("a", 3, 3), ("b", 2, 2)])
    assert rows(TB.latest_row(d, "t")) == [("a", 3, 3)] and TB.latest_row(d.filter("false"), "t").count() == 0
    assert rows(TB.nth_latest(d, "k", "t", 1).select("v")) == [(2,), (3,)]
