"""Nested JSON documents as tables.

A document table has one row per document: an id, the path it came from and its
text.  Documents are parsed once with a fixed schema and exploded; nothing is
collected per date or per ticker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.sources.schemas import SIGNAL

BUCKETS = ("universe", "buy_candidates")
_ITEMS = f"array<struct<{SIGNAL}>>".replace(" string", ": string").replace(" double", ": double").replace(
    "sub_scores struct", "sub_scores: struct").replace("::", ":")
_MAP = f"map<string, {_ITEMS[6:-1]}>"
DOC = (
    f"date string, market_regime string, sector_ratings map<string, struct<rating: string, modifier: double, rationale: string>>, "
    f"universe {_ITEMS}, buy_candidates {_ITEMS}"
)
PREDICTIONS = ("predictions array<struct<ticker: string, predicted_direction: string, prediction_confidence: double, "
               "p_up: double, p_down: double>>")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON files as (path, body); one file is one document."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def path_date(path: str = "path") -> Column:
    """The date directory or file name in a path; NULL when it is not a date."""
    part = F.regexp_extract(F.col(path), r"(\d{4}-\d{2}-\d{2})", 1)
    return F.try_to_date(F.nullif(part, F.lit("")), "yyyy-MM-dd")


def document_dates(docs: DataFrame) -> DataFrame:
    return docs.select(path_date().alias("date")).filter(F.col("date").isNotNull()).distinct()


def latest_document_date(docs: DataFrame, asof, lookback_days: int = 14) -> DataFrame:
    day = F.lit(asof).cast("date")
    d = document_dates(docs)
    return d.filter((F.col("date") >= F.date_sub(day, lookback_days)) & (F.col("date") <= day)).agg(
        F.max("date").alias("latest_date"))


def parse_signals(docs: DataFrame) -> DataFrame:
    """Parsed documents; ``signals`` may be a map by ticker or a plain list."""
    raw = F.get_json_object("body", "$.signals")
    return docs.withColumn("doc", F.from_json("body", DOC)).withColumns({
        "signal_map": F.when(F.startswith(raw, F.lit("{")), F.from_json(raw, _MAP)),
        "signal_list": F.when(F.startswith(raw, F.lit("[")), F.from_json(raw, _ITEMS)),
    })


def _filled(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(-1)) > 0


def has_content(parsed: DataFrame) -> Column:
    return _filled(F.col("signal_map")) | _filled(F.col("signal_list")) | _filled(F.col("doc.universe"))


def valid_documents(parsed: DataFrame) -> DataFrame:
    return parsed.filter(has_content(parsed))


def rejected_documents(parsed: DataFrame) -> DataFrame:
    reason = F.when(F.col("doc").isNull(), "not_json").otherwise("no_content")
    return parsed.filter(~has_content(parsed)).withColumn("reason", reason)


def buy_signals(parsed: DataFrame, min_score: float = 0.0) -> DataFrame:
    """BUY-rated entries of either form; a missing score counts as 0."""
    from_map = parsed.select("doc_id", "doc_date", F.explode("signal_map").alias("ticker", "s")).select(
        "doc_id", "doc_date", "ticker", "s.rating", "s.score")
    from_list = parsed.select("doc_id", "doc_date", F.explode("signal_list").alias("s")).select(
        "doc_id", "doc_date", "s.ticker", "s.rating", "s.score")
    rows = from_map.unionByName(from_list)
    return rows.filter((F.col("rating") == "BUY") & (F.coalesce("score", F.lit(0.0)) >= min_score)).select(
        "doc_id", "doc_date", "ticker", "score")


def referenced_tickers(parsed: DataFrame) -> DataFrame:
    """Distinct (date, ticker) over the map or list, the universe and the candidates."""
    names = F.concat(
        F.coalesce(F.map_keys("signal_map"), F.array()), F.coalesce(F.col("signal_list.ticker"), F.array()),
        F.coalesce(F.col("doc.universe.ticker"), F.array()), F.coalesce(F.col("doc.buy_candidates.ticker"), F.array()))
    return parsed.select("doc_date", F.explode(F.array_distinct(names)).alias("ticker")).filter(
        F.col("ticker").isNotNull()).distinct()


def flat_records(parsed: DataFrame) -> DataFrame:
    """One row per list entry: document, bucket, position and the plain fields."""
    def tagged(bucket: str, field: str) -> Column:
        return F.transform(F.coalesce(F.col(f"doc.{field}"), F.array()), lambda e, i: F.struct(
            F.lit(bucket).alias("bucket"), i.alias("position"), e.alias("s")))

    rows = parsed.select("doc_id", F.col("doc_date").alias("date"), F.explode(F.concat(
        tagged("buy", "buy_candidates"), tagged("universe", "universe"))).alias("x")).select("doc_id", "date", "x.*")
    text = lambda c: F.coalesce(F.col(f"s.{c}"), F.lit("")).alias(c)
    return rows.select(
        "doc_id", "date", "bucket", "position", text("ticker"), text("signal"),
        F.coalesce(F.col("s.score"), F.lit(0.0)).alias("score"), text("conviction"), text("sector"), text("rating"))


def flat_metadata(parsed: DataFrame) -> DataFrame:
    ratings = F.coalesce(F.to_json("doc.sector_ratings"), F.lit("{}"))
    return parsed.select("doc_id", F.col("doc_date").alias("date"),
                         F.coalesce("doc.market_regime", F.lit("neutral")).alias("market_regime"),
                         ratings.alias("sector_ratings_json"))


def rebuild_documents(records: DataFrame, metadata: DataFrame) -> DataFrame:
    """Nested form again.  A group is one document, so its lists are as long as the
    document was."""
    entry = F.struct("position", "ticker", "signal", "score", "conviction", "sector", "rating")
    pick = lambda b: F.transform(
        F.array_sort(F.collect_list(F.when(F.col("bucket") == b, entry))), lambda e: e.dropFields("position"))
    lists = records.groupBy("doc_id").agg(pick("buy").alias("buy_candidates"), pick("universe").alias("universe"))
    return metadata.join(lists, "doc_id", "left").withColumn(
        "sector_ratings", F.from_json("sector_ratings_json",
                                      "map<string, struct<rating: string, modifier: double, rationale: string>>"))


def filter_to_universe(records: DataFrame, universe: DataFrame) -> DataFrame:
    known = universe.select(F.upper("ticker").alias("__u")).distinct()
    return records.join(known, F.upper(records["ticker"]) == F.col("__u"), "left_semi")


def rejected_tickers(records: DataFrame, universe: DataFrame, top: int = 10) -> DataFrame:
    """Entries outside the universe, counted per ticker; the most frequent ones."""
    known = universe.select(F.upper("ticker").alias("__u")).distinct()
    out = records.filter(F.col("ticker") != "").withColumn("ticker", F.upper("ticker"))
    out = out.join(known, F.col("ticker") == F.col("__u"), "left_anti")
    return out.groupBy("ticker").agg(F.count("*").alias("n_rejected")).orderBy(
        F.col("n_rejected").desc(), "ticker").limit(top)


def actionable(records: DataFrame) -> DataFrame:
    """One row per (document, ticker): candidates before universe, then list order."""
    key = F.struct(F.when(F.col("bucket") == "buy", 0).otherwise(1).alias("b"), "position")
    rest = F.struct("date", "bucket", "signal", "score", "conviction", "sector")
    return records.filter(F.col("ticker") != "").groupBy("doc_id", "ticker").agg(
        F.min_by(rest, key).alias("r")).select("doc_id", "ticker", "r.*").filter(
        F.col("signal").isin("ENTER", "EXIT", "REDUCE", "HOLD"))


def signal_lookup(records: DataFrame) -> DataFrame:
    """Per (document, ticker): the first signal in universe-then-candidates order and
    the last sector."""
    key = F.struct(F.when(F.col("bucket") == "universe", 0).otherwise(1).alias("b"), "position")
    return records.filter(F.col("ticker") != "").groupBy("doc_id", "date", "ticker").agg(
        F.min_by("signal", key).alias("signal"), F.min_by("score", key).alias("score"),
        F.max_by("sector", key).alias("sector"))


def predictions(docs: DataFrame) -> DataFrame:
    """Predictions of dated documents; absent numbers are 0, unnamed rows are dropped."""
    dated = docs.filter(~F.contains("path", F.lit("latest"))).withColumn("date", path_date())
    rows = dated.select("doc_id", "date", F.explode(F.from_json("body", PREDICTIONS).predictions).alias("p")).select(
        "doc_id", "date", "p.*")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return rows.filter(F.col("ticker").isNotNull()).select(
        "doc_id", "date", "ticker", "predicted_direction", zero("prediction_confidence"), zero("p_up"), zero("p_down"))


def _sub_scores(s: str) -> Column:
    """Nested scores, else flat ones, else the legacy triple; NULL if none is there."""
    col = lambda f: F.col(f"{s}.{f}")
    n, r = col("sub_scores.news"), col("sub_scores.research")
    parts = F.array_compact(F.array(n, r))
    legacy = F.when(F.size(parts) > 0, F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / F.size(parts))
    pair = lambda a, b: F.struct(a.alias("quant_score"), b.alias("qual_score"))
    nested, flat = (col("sub_scores.quant"), col("sub_scores.qual")), (col("quant_score"), col("qual_score"))
    return (
        F.when(nested[0].isNotNull() | nested[1].isNotNull(), pair(*nested))
        .when(flat[0].isNotNull() | flat[1].isNotNull(), pair(*flat))
        .when(col("sub_scores.technical").isNotNull(), pair(col("sub_scores.technical"), legacy))
    )


def sub_scores(parsed: DataFrame) -> DataFrame:
    """(symbol, score_date, quant_score, qual_score): the map form wins over the list,
    earlier documents and positions over later ones."""
    m = parsed.select("doc_id", "doc_date", F.explode("signal_map").alias("symbol", "s")).select(
        "doc_id", "doc_date", "symbol", F.lit(0).alias("form"), F.lit(0).alias("position"), _sub_scores("s").alias("v"))
    u = parsed.select("doc_id", "doc_date", F.posexplode("doc.universe").alias("position", "s")).select(
        "doc_id", "doc_date", F.col("s.ticker").alias("symbol"), F.lit(1).alias("form"), "position", _sub_scores("s").alias("v"))
    rows = m.unionByName(u).filter(F.col("v").isNotNull() & F.col("symbol").isNotNull())
    return rows.groupBy("symbol", F.col("doc_date").alias("score_date")).agg(
        F.min_by("v", F.struct("form", "doc_id", "position")).alias("v")).select("symbol", "score_date", "v.*")


def with_sub_scores(signals: DataFrame, parsed: DataFrame) -> DataFrame:
    own = signals.drop("quant_score", "qual_score")
    return own.join(sub_scores(parsed), ["symbol", "score_date"], "left")


def boosts(parsed: DataFrame) -> DataFrame:
    """Boost values of every entry; a ticker named twice keeps both rows."""
    parts = [parsed.select("doc_date", F.explode(f"doc.{b}").alias("s")) for b in BUCKETS]
    zero = lambda c: F.coalesce(F.col(f"s.{c}"), F.lit(0.0)).alias(c)
    return parts[0].unionByName(parts[1]).filter(F.col("s.ticker").isNotNull()).select(
        F.col("s.ticker").alias("symbol"), F.col("doc_date").alias("score_date"),
        zero("short_interest_adj"), zero("institutional_boost"))


def recent_regimes(parsed: DataFrame, n: int = 60) -> DataFrame:
    """Market regime of the n latest document dates; neutral when not stated."""
    per_day = parsed.groupBy(F.col("doc_date").alias("date")).agg(
        F.max_by(F.coalesce("doc.market_regime", F.lit("neutral")), "doc_id").alias("market_regime"))
    return per_day.orderBy(F.col("date").desc()).limit(n)


TRAINING = ("feature_ics map<string, double>, walk_forward struct<median_ic: double>, test_ic double, "
            "noise_candidates array<string>, deployed_at string")


def training_feature_ics(docs: DataFrame, key: str = "version") -> DataFrame:
    return docs.select(key, F.explode(F.from_json("body", TRAINING).feature_ics).alias("feature", "training_ic"))


def training_ic(docs: DataFrame, key: str = "version") -> DataFrame:
    d = F.from_json("body", TRAINING)
    return docs.select(key, F.coalesce(d.walk_forward.median_ic, d.test_ic, F.lit(0.0)).alias("training_ic"))


def model_metadata(docs: DataFrame, key: str = "version") -> DataFrame:
    """Deployment time and noise features; documents with neither are left out."""
    d = docs.withColumn("m", F.from_json("body", TRAINING))
    return d.filter(F.col("m.deployed_at").isNotNull() | F.col("m.noise_candidates").isNotNull()).select(
        key, F.to_date(F.substring("m.deployed_at", 1, 10)).alias("deployed_on"),
        F.array_join("m.noise_candidates", ",").alias("noise_candidates"))


def parameters(docs: DataFrame, defaults: dict[str, float], key: str = "doc_id") -> DataFrame:
    """(document, key, value): known keys only, defaults where the document has none."""
    given = docs.select(key, F.from_json("body", "map<string, double>").alias("m"))
    known = F.explode(F.array(*[
        F.struct(F.lit(k).alias("key"), F.lit(float(v)).alias("default")) for k, v in defaults.items()])).alias("d")
    return given.select(key, "m", known).select(
        key, "d.key", F.coalesce(F.col("m")[F.col("d.key")], F.col("d.default")).alias("value"))


def sector_map(docs: DataFrame) -> DataFrame:
    return docs.select(F.explode(F.from_json("body", "map<string, string>")).alias("ticker", "sector_etf")).distinct()


def grade_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Graded document as (document, component, grade): modules, their components, teams."""
    module = "struct<grade: double, components: map<string, string>>"
    d = docs.select(key, F.from_json("body", f"research {module}, predictor {module}, executor {module}").alias("g"))
    mods = d.select(key, F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), F.col(f"g.{m}").alias("v")) for m in ("research", "predictor", "executor")
    ])).alias("x")).select(key, "x.m", "x.v")
    top = mods.select(key, F.col("m").alias("component"), F.col("v.grade").alias("grade"))
    parts = mods.select(key, "m", F.explode("v.components").alias("c", "raw"))
    plain = parts.filter(F.startswith("raw", F.lit("{"))).select(
        key, F.concat_ws(".", "m", "c").alias("component"), F.from_json("raw", "grade double").grade.alias("grade"))
    teams = parts.filter(F.startswith("raw", F.lit("["))).select(
        key, "m", F.explode(F.from_json("raw", "array<struct<team_id: string, grade: double>>")).alias("t")).select(
        key, F.concat(F.col("m"), F.lit(".team."), F.col("t.team_id")).alias("component"), F.col("t.grade").alias("grade"))
    return top.unionByName(plain).unionByName(teams)


POSITIONS = "map<string, struct<shares: int, avg_cost: double, entry_date: string, sector: string>>"


def snapshot_asof(snapshots: DataFrame, trades: DataFrame, start, key: str = "account",
                  order: str = "snapshot_id") -> DataFrame:
    """Opening positions per account: the last usable snapshot before ``start``, else
    the first usable one; entry date from the latest ENTER up to then."""
    day = F.lit(start).cast("date")
    usable = F.col("total_cash").isNotNull() & (F.length("positions_snapshot") > 2)
    body = F.struct("date", "total_cash", "positions_snapshot")
    at = F.struct("date", order)
    chosen = snapshots.filter(usable).groupBy(key).agg(
        F.coalesce(F.max_by(F.when(F.col("date") < day, body), F.when(F.col("date") < day, at)), F.min_by(body, at))
        .alias("r")).select(key, F.col("r.date").alias("as_of"), F.col("r.total_cash").alias("cash"), "r.positions_snapshot")
    peak = snapshots.join(chosen.select(key, "as_of"), key).filter(F.col("date") <= F.col("as_of")).groupBy(key).agg(
        F.max("portfolio_nav").alias("peak_nav"))
    rows = chosen.join(peak, key).select(
        key, "as_of", "cash", "peak_nav", F.explode(F.from_json("positions_snapshot", POSITIONS)).alias("ticker", "p"))
    rows = rows.filter(F.coalesce("p.shares", F.lit(0)) != 0)
    enters = trades.filter(F.col("action") == "ENTER").select("ticker", "date").distinct()
    asked = rows.select("ticker", "as_of").distinct()
    last = Window.partitionBy("ticker").orderBy("as_of", "k").rowsBetween(Window.unboundedPreceding, 0)
    both = asked.withColumns({"d": F.lit(None).cast("date"), "k": F.lit(1)}).unionByName(
        enters.select("ticker", F.col("date").alias("as_of"), F.col("date").alias("d"), F.lit(0).alias("k")))
    entry = both.withColumn("entered", F.last("d", ignorenulls=True).over(last)).filter("k = 1").select(
        "ticker", "as_of", "entered")
    return rows.join(entry, ["ticker", "as_of"], "left").select(
        key, "as_of", "cash", "peak_nav", "ticker", F.col("p.shares").alias("shares"),
        F.coalesce("p.avg_cost", F.lit(0.0)).alias("avg_cost"), F.coalesce("p.sector", F.lit("")).alias("sector"),
        F.coalesce(F.to_date("p.entry_date"), F.col("entered"), F.col("as_of")).alias("entry_date"))
