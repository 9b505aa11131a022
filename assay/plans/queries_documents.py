"""Document and table-shape queries with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F


from assay.operators import decisions as D
from assay.operators import predictor as P
from assay.plans.queries_quality import pearson_sql
from assay.plans.registry import query
from assay.plans.views import r
from assay.sources import documents as DOC
from assay.sources import tables as TB


def parsed(t):
    return DOC.parse_signals(t.signal_docs)


def _list(field: str, bucket: str) -> str:
    return f"SELECT doc_id, doc_date AS date, '{bucket}' AS bucket, i AS position, json_extract(body, concat('$.{field}[', i, ']')) AS e FROM {{signal_docs}}, unnest(range(CAST(coalesce(json_array_length(body, '$.{field}'), 0) AS BIGINT))) r(i)"


def _s(path: str, src: str = "e") -> str:
    return f"json_extract_string({src}, '$.{path}')"


def _n(path: str, src: str = "e") -> str:
    return f"TRY_CAST(json_extract_string({src}, '$.{path}') AS DOUBLE)"


REC = f"""(SELECT doc_id, date, bucket, position, coalesce({_s('ticker')}, '') AS ticker, coalesce({_s('signal')}, '') AS signal, coalesce({_n('score')}, 0e0) AS score, coalesce({_s('conviction')}, '') AS conviction,
  coalesce({_s('sector')}, '') AS sector, coalesce({_s('rating')}, '') AS rating FROM ({_list('buy_candidates', 'buy')} UNION ALL {_list('universe', 'universe')}))"""
MAPROWS = "(SELECT doc_id, doc_date, k AS ticker, json_extract(body, concat('$.signals.', k)) AS e FROM {signal_docs}, unnest(CASE WHEN json_type(body, '$.signals') = 'OBJECT' THEN json_keys(body, '$.signals') ELSE [] END) u(k))"
LISTROWS = "(SELECT doc_id, doc_date, json_extract(body, concat('$.signals[', i, ']')) AS e FROM {signal_docs}, unnest(range(CAST(CASE WHEN json_type(body, '$.signals') = 'ARRAY' THEN json_array_length(body, '$.signals') ELSE 0 END AS BIGINT))) r(i))"
PATH_DATE = "TRY_CAST(nullif(regexp_extract(path, '([0-9]+-[0-9]+-[0-9]+)', 1), '') AS DATE)"


@query("document_dates", f"SELECT DISTINCT CAST({PATH_DATE} AS VARCHAR) AS date FROM {{signal_docs}} WHERE {PATH_DATE} IS NOT NULL")
def _(t):
    return DOC.document_dates(t.signal_docs)


@query("latest_document_date", f"SELECT CAST(max({PATH_DATE}) AS VARCHAR) AS latest_date FROM {{signal_docs}} WHERE {PATH_DATE} BETWEEN DATE '2001-07-20' - 14 AND DATE '2001-07-20'")
def _(t):
    return DOC.latest_document_date(t.signal_docs, "2001-07-20")


_CONTENT = "(json_type(body, '$.signals') IN ('OBJECT', 'ARRAY') OR coalesce(json_array_length(body, '$.universe'), 0) > 0)"


@query("valid_documents", f"SELECT doc_id, path, CAST(coalesce(json_array_length(body, '$.universe'), 0) AS INT) AS n_universe FROM {{signal_docs}} WHERE coalesce({_CONTENT}, false)")
def _(t):
    return DOC.valid_documents(parsed(t)).select("doc_id", "path", F.coalesce(F.size("doc.universe"), F.lit(0)).alias("n_universe"))


@query("rejected_documents", f"SELECT doc_id, path, 'no_content' AS reason FROM {{signal_docs}} WHERE NOT coalesce({_CONTENT}, false)")
def _(t):
    return DOC.rejected_documents(parsed(t)).select("doc_id", "path", "reason")


@query("document_buy_signals", f"""SELECT doc_id, CAST(doc_date AS VARCHAR) AS doc_date, ticker, {_n('score')} AS score FROM {MAPROWS} WHERE {_s('rating')} = 'BUY' AND coalesce({_n('score')}, 0) >= 70
 UNION ALL SELECT doc_id, CAST(doc_date AS VARCHAR), {_s('ticker')}, {_n('score')} FROM {LISTROWS} WHERE {_s('rating')} = 'BUY' AND coalesce({_n('score')}, 0) >= 70""")
def _(t):
    return DOC.buy_signals(parsed(t), 70.0)


@query("referenced_tickers", f"""SELECT CAST(doc_date AS VARCHAR) AS doc_date, ticker FROM {MAPROWS} UNION SELECT CAST(doc_date AS VARCHAR), {_s('ticker')} FROM {LISTROWS}
 UNION SELECT CAST(date AS VARCHAR), ticker FROM {REC} WHERE ticker <> ''""")
def _(t):
    return DOC.referenced_tickers(parsed(t))


@query("flat_signal_records", f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM {REC}")
def _(t):
    return DOC.flat_records(parsed(t))


@query("flat_signal_metadata", """SELECT doc_id, CAST(doc_date AS VARCHAR) AS date, coalesce(json_extract_string(body, '$.market_regime'), 'neutral') AS market_regime,
  CASE WHEN json_exists(body, '$.sector_ratings') THEN json_keys(body, '$.sector_ratings')[1] END AS rated_sector FROM {signal_docs}""")
def _(t):
    meta = DOC.flat_metadata(parsed(t))
    keys = F.map_keys(F.from_json("sector_ratings_json", "map<string, string>"))
    return meta.select("doc_id", "date", "market_regime", F.when(F.size(keys) > 0, F.element_at(keys, 1)).alias("rated_sector"))


@query("rebuilt_documents", f"""SELECT m.doc_id, CAST(m.doc_date AS VARCHAR) AS date, coalesce(json_extract_string(body, '$.market_regime'), 'neutral') AS market_regime, coalesce(b.t, '') AS buys, coalesce(u.t, '') AS others, json_extract_string(body, concat('$.sector_ratings.', coalesce(json_keys(body, '$.sector_ratings')[1], 'none'), '.rating')) AS rating
 FROM {{signal_docs}} m LEFT JOIN (SELECT doc_id, string_agg(ticker, ',' ORDER BY position) AS t FROM {REC} WHERE bucket = 'buy' GROUP BY 1) b USING (doc_id) LEFT JOIN (SELECT doc_id, string_agg(ticker, ',' ORDER BY position) AS t FROM {REC} WHERE bucket = 'universe' GROUP BY 1) u USING (doc_id)""")
def _(t):
    """Flattened and put together again; lists shown as text in their order."""
    p = parsed(t)
    back = DOC.rebuild_documents(DOC.flat_records(p), DOC.flat_metadata(p))
    text = lambda c: F.coalesce(F.array_join(F.col(f"{c}.ticker"), ","), F.lit(""))
    return back.select("doc_id", "date", "market_regime", text("buy_candidates").alias("buys"), text("universe").alias("others"),
                       F.try_element_at(F.map_values("sector_ratings"), F.lit(1)).rating.alias("rating"))


_UNI = "(SELECT DISTINCT upper(concat('S', CAST(c_custkey AS VARCHAR))) AS tk FROM {customer} WHERE c_custkey % 5 <> 0)"


def _known(t):
    return t.customer.filter("c_custkey % 5 <> 0").select(F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("ticker"))


@query("records_in_universe", f"SELECT doc_id, bucket, position, ticker FROM {REC} WHERE upper(ticker) IN (SELECT tk FROM {_UNI})")
def _(t):
    return DOC.filter_to_universe(DOC.flat_records(parsed(t)), _known(t)).select("doc_id", "bucket", "position", "ticker")


@query("rejected_tickers", f"SELECT upper(ticker) AS ticker, count(*) AS n_rejected FROM {REC} WHERE ticker <> '' AND upper(ticker) NOT IN (SELECT tk FROM {_UNI}) GROUP BY 1 ORDER BY n_rejected DESC, ticker LIMIT 10")
def _(t):
    return DOC.rejected_tickers(DOC.flat_records(parsed(t)), _known(t))


ACTIONABLE = f"(SELECT * FROM (SELECT * FROM {REC} WHERE ticker <> '' QUALIFY row_number() OVER (PARTITION BY doc_id, ticker ORDER BY CASE WHEN bucket = 'buy' THEN 0 ELSE 1 END, position) = 1) WHERE signal IN ('ENTER', 'EXIT', 'REDUCE', 'HOLD'))"


@query("actionable_signals", f"SELECT doc_id, ticker, CAST(date AS VARCHAR) AS date, bucket, signal, score, conviction, sector FROM {ACTIONABLE}")
def _(t):
    return DOC.actionable(DOC.flat_records(parsed(t)))


@query("signal_lookup", f"""SELECT doc_id, CAST(date AS VARCHAR) AS date, ticker, first(signal ORDER BY k, position) AS signal, first(score ORDER BY k, position) AS score, last(sector ORDER BY k, position) AS sector
 FROM (SELECT *, CASE WHEN bucket = 'universe' THEN 0 ELSE 1 END AS k FROM {REC} WHERE ticker <> '') GROUP BY 1, 2, 3""")
def _(t):
    return DOC.signal_lookup(DOC.flat_records(parsed(t)))


@query("research_actions", f"""SELECT CAST(date AS VARCHAR) AS date, ticker, CASE max(CASE signal WHEN 'REDUCE' THEN 3 WHEN 'EXIT' THEN 2 WHEN 'ENTER' THEN 1 ELSE 0 END) WHEN 3 THEN 'REDUCE' WHEN 2 THEN 'EXIT' WHEN 1 THEN 'ENTER' ELSE 'HOLD' END AS research_action
 FROM {ACTIONABLE} GROUP BY 1, 2""")
def _(t):
    return D.research_actions(DOC.actionable(DOC.flat_records(parsed(t))))


_PRED = f"""(SELECT doc_id, {PATH_DATE} AS date, json_extract(body, concat('$.predictions[', i, ']')) AS e FROM {{prediction_docs}}, unnest(range(CAST(json_array_length(body, '$.predictions') AS BIGINT))) r(i) WHERE NOT contains(path, 'latest'))"""


@query("document_predictions", f"SELECT doc_id, CAST(date AS VARCHAR) AS date, {_s('ticker')} AS ticker, {_s('predicted_direction')} AS predicted_direction, coalesce({_n('prediction_confidence')}, 0e0) AS prediction_confidence, coalesce({_n('p_up')}, 0e0) AS p_up, coalesce({_n('p_down')}, 0e0) AS p_down FROM {_PRED} WHERE {_s('ticker')} IS NOT NULL")
def _(t):
    return DOC.predictions(t.prediction_docs)


_Q, _L = _n("sub_scores.quant"), _n("sub_scores.qual")
_FQ, _FL, _TE, _NE, _RE = _n("quant_score"), _n("qual_score"), _n("sub_scores.technical"), _n("sub_scores.news"), _n("sub_scores.research")
_SUBROWS = f"""(SELECT doc_id, d, symbol, form, position, CASE WHEN coalesce({_Q}, {_L}) IS NOT NULL THEN {_Q} WHEN coalesce({_FQ}, {_FL}) IS NOT NULL THEN {_FQ} ELSE {_TE} END AS quant_score,
   CASE WHEN coalesce({_Q}, {_L}) IS NOT NULL THEN {_L} WHEN coalesce({_FQ}, {_FL}) IS NOT NULL THEN {_FL} WHEN {_TE} IS NOT NULL THEN (coalesce({_NE}, 0e0) + coalesce({_RE}, 0e0)) / nullif((CASE WHEN {_NE} IS NULL THEN 0 ELSE 1 END) + (CASE WHEN {_RE} IS NULL THEN 0 ELSE 1 END), 0) END AS qual_score
 FROM (SELECT doc_id, doc_date AS d, ticker AS symbol, 0 AS form, 0 AS position, e FROM {MAPROWS} UNION ALL SELECT doc_id, date, {_s('ticker')}, 1, position, e FROM ({_list('universe', 'universe')}))
 WHERE coalesce({_Q}, {_L}, {_FQ}, {_FL}, {_TE}) IS NOT NULL AND symbol IS NOT NULL)"""
SUB = f"(SELECT symbol, d AS score_date, quant_score, qual_score FROM {_SUBROWS} QUALIFY row_number() OVER (PARTITION BY symbol, d ORDER BY form, doc_id, position) = 1)"


@query("document_sub_scores", f"SELECT symbol, CAST(score_date AS VARCHAR) AS score_date, quant_score, qual_score FROM {SUB}")
def _(t):
    return DOC.sub_scores(parsed(t))


def _resolved(t):
    return t.predictor_outcomes.select("symbol", F.col("prediction_date").alias("score_date"), F.col("correct_5d").alias("beat_spy_10d"),
                                       F.when(F.col("id") % 4 != 0, F.col("correct_5d")).alias("beat_spy_30d"))


@query("signals_with_sub_scores", f"SELECT o.symbol, CAST(o.prediction_date AS VARCHAR) AS score_date, correct_5d AS beat_spy_10d, CASE WHEN id % 4 <> 0 THEN correct_5d END AS beat_spy_30d, quant_score, qual_score FROM {{predictor_outcomes}} o LEFT JOIN {SUB} s ON o.symbol = s.symbol AND o.prediction_date = s.score_date")
def _(t):
    return DOC.with_sub_scores(_resolved(t), parsed(t))


_BOOST = f"(SELECT {_s('ticker')} AS symbol, date AS score_date, coalesce({_n('short_interest_adj')}, 0e0) AS short_interest_adj, coalesce({_n('institutional_boost')}, 0e0) AS institutional_boost FROM ({_list('buy_candidates', 'buy')} UNION ALL {_list('universe', 'universe')}) WHERE {_s('ticker')} IS NOT NULL)"


@query("document_boosts", f"SELECT symbol, CAST(score_date AS VARCHAR) AS score_date, short_interest_adj, institutional_boost FROM {_BOOST}")
def _(t):
    return DOC.boosts(parsed(t))


_BJ = f"(SELECT o.correct_5d AS beat_spy_10d, CASE WHEN id % 4 <> 0 THEN correct_5d END AS beat_spy_30d, b.short_interest_adj, b.institutional_boost FROM {{predictor_outcomes}} o LEFT JOIN {_BOOST} b ON o.symbol = b.symbol AND o.prediction_date = b.score_date WHERE correct_5d IS NOT NULL)"
BOOST_ROWS = " UNION ALL ".join(
    f"SELECT '{b}' AS boost, count(CASE WHEN {b} IS NOT NULL AND beat_spy_10d IS NOT NULL THEN 1 END) AS n, count(CASE WHEN {b} <> 0 THEN 1 END) AS n_nonzero, {r(f'avg(CASE WHEN {b} <> 0 THEN {b} END)', 4)} AS mean_nonzero, {r(pearson_sql(b, 'beat_spy_10d', 20))} AS r_10d, {r(pearson_sql(b, 'beat_spy_30d', 20))} AS r_30d FROM {_BJ}"
    for b in ("short_interest_adj", "institutional_boost"))


def boost_rows(t):
    j = _resolved(t).filter("beat_spy_10d IS NOT NULL").join(DOC.boosts(parsed(t)), ["symbol", "score_date"], "left")
    return P.boost_correlations(j, ["short_interest_adj", "institutional_boost"])


@query("boost_correlations", BOOST_ROWS)
def _(t):
    return boost_rows(t)


@query("recent_regimes", """SELECT CAST(doc_date AS VARCHAR) AS date, coalesce(max_by(coalesce(json_extract_string(body, '$.market_regime'), 'neutral'), doc_id), 'neutral') AS market_regime FROM {signal_docs} GROUP BY doc_date ORDER BY doc_date DESC LIMIT 60""")
def _(t):
    return DOC.recent_regimes(parsed(t))


@query("training_feature_ics", "SELECT version, k AS feature, CAST(json_extract_string(body, concat('$.feature_ics.', k)) AS DOUBLE) AS training_ic FROM {training_docs}, unnest(json_keys(body, '$.feature_ics')) u(k)")
def _(t):
    return DOC.training_feature_ics(t.training_docs)


@query("training_ic", "SELECT version, coalesce(CAST(json_extract_string(body, '$.walk_forward.median_ic') AS DOUBLE), CAST(json_extract_string(body, '$.test_ic') AS DOUBLE), 0e0) AS training_ic FROM {training_docs}")
def _(t):
    return DOC.training_ic(t.training_docs)


@query("model_metadata", """SELECT version, CASE WHEN json_exists(body, '$.deployed_at') THEN substr(json_extract_string(body, '$.deployed_at'), 1, 10) END AS deployed_on, CASE WHEN json_exists(body, '$.noise_candidates') THEN 'breadth,rsi_14' END AS noise_candidates
 FROM {training_docs} WHERE json_exists(body, '$.deployed_at') OR json_exists(body, '$.noise_candidates')""")
def _(t):
    return DOC.model_metadata(t.training_docs)


SCANNER_DEFAULTS = {"tech_score_min": 60.0, "max_atr_pct": 8.0, "min_avg_volume": 500000.0}
PARAMS = "(SELECT doc_id, d.key, coalesce(TRY_CAST(json_extract_string(body, concat('$.', d.key)) AS DOUBLE), d.v) AS value FROM {parameter_docs}, (VALUES ('tech_score_min', 60e0), ('max_atr_pct', 8e0), ('min_avg_volume', 500000e0)) d(key, v))"


@query("document_parameters", f"SELECT * FROM {PARAMS}")
def _(t):
    return DOC.parameters(t.parameter_docs, SCANNER_DEFAULTS)


@query("sector_map", "SELECT DISTINCT json_keys(body)[1] AS ticker, json_extract_string(body, concat('$.', json_keys(body)[1])) AS sector_etf FROM {sector_map_docs}")
def _(t):
    return DOC.sector_map(t.sector_map_docs)


@query("grade_rows", """SELECT doc_id, m AS component, TRY_CAST(json_extract_string(body, concat('$.', m, '.grade')) AS DOUBLE) AS grade FROM {grade_docs}, (VALUES ('research'), ('predictor'), ('executor')) v(m)
 UNION ALL SELECT doc_id, 'research.scanner', TRY_CAST(json_extract_string(body, '$.research.components.scanner.grade') AS DOUBLE) FROM {grade_docs}
 UNION ALL SELECT doc_id, 'predictor.veto_gate', TRY_CAST(json_extract_string(body, '$.predictor.components.veto_gate.grade') AS DOUBLE) FROM {grade_docs}
 UNION ALL SELECT doc_id, concat('research.team.', json_extract_string(body, concat('$.research.components.sector_teams[', i, '].team_id'))), TRY_CAST(json_extract_string(body, concat('$.research.components.sector_teams[', i, '].grade')) AS DOUBLE) FROM {grade_docs}, (VALUES (0), (1)) v(i)""")
def _(t):
    return DOC.grade_rows(t.grade_docs)


_US = "(SELECT * FROM {account_days} WHERE total_cash IS NOT NULL AND length(positions_snapshot) > 2)"


@query("opening_positions", f"""WITH ch AS (SELECT * FROM {_US} QUALIFY row_number() OVER (PARTITION BY account ORDER BY CASE WHEN date < DATE '2024-01-12' THEN 0 ELSE 1 END, CASE WHEN date < DATE '2024-01-12' THEN -epoch(date::TIMESTAMP) ELSE epoch(date::TIMESTAMP) END, CASE WHEN date < DATE '2024-01-12' THEN -snapshot_id ELSE snapshot_id END) = 1),
 pk AS (SELECT c.account, max(a.portfolio_nav) AS peak_nav FROM ch c JOIN {{account_days}} a ON a.account = c.account AND a.date <= c.date GROUP BY 1),
 en AS (SELECT DISTINCT concat('T', CAST(user_id % 40 AS VARCHAR)) AS ticker, CAST(ts AS DATE) AS date FROM {{events}} WHERE event_type = 'view')
 SELECT account, CAST(as_of AS VARCHAR) AS as_of, cash, peak_nav, ticker, shares, avg_cost, sector, CAST(coalesce((SELECT max(date) FROM en WHERE en.ticker = x.ticker AND en.date <= x.as_of), as_of) AS VARCHAR) AS entry_date FROM (
  SELECT c.account, c.date AS as_of, c.total_cash AS cash, pk.peak_nav, k AS ticker, CAST(json_extract_string(positions_snapshot, concat('$.', k, '.shares')) AS INT) AS shares, CAST(json_extract_string(positions_snapshot, concat('$.', k, '.avg_cost')) AS DOUBLE) AS avg_cost,
   json_extract_string(positions_snapshot, concat('$.', k, '.sector')) AS sector FROM ch c JOIN pk USING (account), unnest(json_keys(positions_snapshot)) u(k)) x WHERE shares <> 0""")
def _(t):
    entries = t.events.filter("event_type = 'view'").select(
        F.concat(F.lit("T"), (F.col("user_id") % 40).cast("string")).alias("ticker"), F.col("ts").cast("date").alias("date"), F.lit("ENTER").alias("action"))
    return DOC.snapshot_asof(t.account_days, entries, "2024-01-12")


# --- table shape -----------------------------------------------------------------

@query("unified_frames", """SELECT ticker, CAST(date AS VARCHAR) AS date, CAST(volume AS DOUBLE) AS volume, close, CAST(NULL AS DOUBLE) AS vwap FROM {event_bars} WHERE volume > 2
 UNION ALL SELECT ticker, CAST(date AS VARCHAR), CAST(volume AS DOUBLE), NULL, vwap FROM {event_bars} WHERE volume <= 2""")
def _(t):
    """Frames with different columns and numeric types, stacked."""
    a = t.event_bars.filter("volume > 2").select("ticker", "date", F.col("volume").cast("bigint").alias("volume"), "close")
    b = t.event_bars.filter("volume <= 2").select("vwap", "ticker", F.col("volume").cast("float").alias("volume"), "date")
    return TB.unify([a, b])


@query("stacked_series", """SELECT CAST(date AS VARCHAR) AS date, 'open' AS ticker, avg_open AS value FROM (SELECT date, max(open) AS avg_open FROM {event_bars} GROUP BY 1)
 UNION ALL SELECT CAST(date AS VARCHAR), 'close', max(close) FROM {event_bars} WHERE volume > 5 GROUP BY date""")
def _(t):
    wide = t.event_bars.groupBy("date").agg(F.max("open").alias("open"), F.max(F.when(F.col("volume") > 5, F.col("close"))).alias("close"))
    return TB.stack_series(wide, "date")




@query("history_upsert", """SELECT CAST(date AS VARCHAR) AS date, n, src FROM (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n, 'old' AS src FROM {orders} WHERE CAST(o_orderdate AS DATE) < DATE '2001-07-10' GROUP BY 1
 UNION ALL SELECT CAST(o_orderdate AS DATE), count(*), 'new' FROM {orders} WHERE CAST(o_orderdate AS DATE) >= DATE '2001-07-10' GROUP BY 1) ORDER BY date DESC LIMIT 52""")
def _(t):
    """New rows replace stored ones of the same date; the last 52 dates stay."""
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count("*").alias("n"))
    old = daily.filter("date < DATE '2001-07-20'").withColumn("src", F.lit("old"))
    new = daily.filter("date >= DATE '2001-07-10'").withColumn("src", F.lit("new"))
    return TB.upsert_by_date(old, new, "date", 52)


@query("idempotent_append", """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS run_date, count(*) AS n, CASE WHEN CAST(o_orderdate AS DATE) = DATE '2001-07-30' THEN 1.5e0 END AS extra FROM {orders} GROUP BY CAST(o_orderdate AS DATE)""")
def _(t):
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("run_date")).agg(F.count("*").alias("n"))
    row = daily.filter("run_date = DATE '2001-07-30'").withColumn("extra", F.lit(1.5))
    return TB.append_once(daily, row)


@query("json_round_trip", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM {orders}")
def _(t):
    docs = TB.as_json(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), "o_orderkey")
    return TB.from_json_rows(docs, "o_orderkey", "o_totalprice double, o_orderstatus string")


@query("latest_snapshot", "SELECT max_by(o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR || lpad(o_orderkey::VARCHAR, 12, '0')) AS o_orderkey, max_by(o_totalprice, CAST(o_orderdate AS DATE)::VARCHAR || lpad(o_orderkey::VARCHAR, 12, '0')) AS o_totalprice FROM {orders}")
def _(t):
    d = t.orders.select("o_orderkey", "o_totalprice", F.concat(
        F.col("o_orderdate").cast("date").cast("string"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("k"))
    return TB.latest_row(d, "k").drop("k")


@query("trades_since", "SELECT trade_id, CAST(date AS VARCHAR) AS date, ticker, action, fill_price FROM {trades} WHERE date >= DATE '2000-01-01'")
def _(t):
    return TB.trades_since(t.trades, "2000-01-01").select("trade_id", "date", "ticker", "action", "fill_price")


