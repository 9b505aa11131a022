"""Queries of the operators over the given tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    exact_dedup, language, license_scan, mixing, ngram_join, packing, quality_model, quality_rules, spelling,
    substring_dedup, suffix_dedup, target_sampling, topk_search,
)
from .common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT *, [3, 1, 2][1 + rank % 3] AS weight, 2 * source_size AS lim FROM (
    SELECT source, sum(size)::BIGINT AS source_size,
           (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1)::BIGINT AS rank FROM d GROUP BY source)
), f AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)::DOUBLE
             - coalesce(sum(lim) OVER (ORDER BY lim::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / sum(weight) OVER (ORDER BY lim::DOUBLE / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM s
), g AS (
  SELECT *, first(CASE WHEN level * weight <= lim THEN level END IGNORE NULLS)
            OVER (ORDER BY lim::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS final FROM f
), t AS (
  SELECT source, source_size, coalesce(final * weight, lim::DOUBLE) AS target FROM g
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, least(floor(t.target)::BIGINT, 2 * t.source_size) AS take,
         coalesce(sum(d.size) OVER (PARTITION BY d.source
           ORDER BY ('0x' || substr(md5('7-' || coalesce(d.doc_id || '-', '') || d.size), 1, 8))::BIGINT
                    % (SELECT greatest(1, pow(2, ceil(log2(greatest(count(*) / 4096.0, 1)))))::BIGINT FROM documents),
                    md5('7-' || coalesce(d.doc_id || '-', '') || d.size), d.doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS position
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, take - position)) + greatest(0, least(size, take - source_size - position)))::BIGINT AS taken
FROM p
"""


@query("op1_mixing", OP1_SQL)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(*mixing.mix(documents(spark, sf_dir, "doc_id", "text", "source")))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256,
         strlen(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))::BIGINT AS text_size FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256, text_size
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


@query("op2_exact_dedup", OP2_SQL)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path()).drop("ids")


@query("op4_quality_model")
def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op8_language")
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_all(documents(spark, sf_dir, "doc_id", "text", "lang"))


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), c AS (
  SELECT *, len(ws)::BIGINT AS n_words, strlen(t) AS bytes, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS up, length(regexp_replace(t, '[^0-9]', '', 'g')) AS dig,
    length(regexp_replace(t, '[^!]', '', 'g')) AS shout,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS g
  FROM w
), m AS (
  SELECT doc_id, g, s, count(*) OVER (PARTITION BY rid, s) > 1 AS many, i, rid
  FROM (SELECT doc_id, g, unnest(g) AS s, generate_subscripts(g, 1) AS i, rid FROM (SELECT *, row_number() OVER () AS rid FROM c))
), r AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM m, (SELECT unnest([0, 1, 2]) AS k) WHERE many GROUP BY rid
), a AS (
  SELECT c.*, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM (SELECT *, row_number() OVER () AS rid FROM c) c LEFT JOIN r USING (rid)
), f AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM a
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 5 * n_symbols > n_words OR 10 * up > 3 * word_chars OR 10 * dig > 3 * word_chars
       OR 2 * shout > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
       OR 10 * n_dup_lines > 4 * len(ls) OR 10 * len(list_distinct(ws)) < n_words) AS kept
FROM f
"""


@query("op10_quality_rules", OP10_SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


OP7_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS g FROM w
), u AS (
  SELECT doc_id, len(g)::BIGINT AS n, unnest(g) AS x FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  WITH RECURSIVE r AS (SELECT a AS doc_id, a AS other FROM p UNION SELECT r.doc_id, p.b FROM r JOIN p ON r.other = p.a) SELECT * FROM r
)
SELECT doc_id, len(g)::BIGINT AS n_shingles, least(doc_id, (SELECT min(other) FROM reach WHERE reach.doc_id = s.doc_id))::BIGINT AS component_id
FROM s
"""


@query("op7_ngram_join", OP7_SQL)
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(documents(spark, sf_dir), width=3, similarity=Fraction(90, 100))
    return found.select("doc_id", "n_shingles", "component_id")


OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)
), l AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS later FROM g
), c AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM l WHERE later
), k AS (
  SELECT u.doc_id, count(*) AS n, string_agg(u.x, ' ' ORDER BY u.j) AS kept
  FROM (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS j FROM w) u
  WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.doc_id = u.doc_id AND c.j = u.j) GROUP BY u.doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""


@query("op3_substring_dedup", OP3_SQL)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))


@query("op5_license_scan")
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir)).drop("detections")


#: CRC-32 of a text as an integer: eight steps per byte of its UTF-8 form.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen({0})), lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, k: xor(c // 2, 3988292384 * (c % 2)))), 4294967295)"""

OP11_SQL = r"""
WITH x AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), y AS (
  SELECT regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), r AS (
  SELECT rid, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]),
    list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS f FROM x
), e AS (
  SELECT unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]),
    list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS f FROM y
), b AS MATERIALIZED (
  SELECT f, """ + _CRC.format("f") + r""" % 10000 AS bucket FROM (SELECT f FROM r UNION SELECT f FROM e)
), n AS (
  SELECT bucket, sum(s) AS s, sum(t) AS t FROM (
    SELECT bucket, 1 AS s, 0 AS t FROM r JOIN b USING (f) UNION ALL SELECT bucket, 0, 1 FROM e JOIN b USING (f)) GROUP BY bucket
), g AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM n) + 10000)::DOUBLE
                                 / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n) + 10000)::DOUBLE)))::BIGINT AS gain FROM n
), w AS (
  SELECT rid, sum(gain)::BIGINT AS weight FROM r JOIN b USING (f) JOIN g USING (bucket) GROUP BY rid
), d AS (
  SELECT doc_id, len(ws) AS n_words, (len(ws) + greatest(len(ws) - 1, 0) + greatest(len(ws) - 2, 0))::BIGINT AS n_features,
         coalesce(weight, 0) AS weight, (coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296::DOUBLE))))::BIGINT AS score
  FROM x LEFT JOIN w USING (rid)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
         count(*) OVER (PARTITION BY n_words >= 20) AS n FROM d
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank FROM o
"""


@query("op11_importance_resampling", OP11_SQL)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = target_sampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("n_words")


OP12_SQL = r"""
WITH RECURSIVE x AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), p AS (
  SELECT doc_id, run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM x GROUP BY doc_id, run
), h AS MATERIALIZED (
  SELECT run, n, """ + _CRC.format("s") + r""" AS h FROM p
), w AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), d AS MATERIALIZED (
  SELECT word, n, i, left(word, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.rest = w.word
  UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(struct_pack(other := other, n := n), (-n, encode(other))) AS top FROM near GROUP BY word
), f AS MATERIALIZED (
  SELECT word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top.n >= 10 * w.n THEN top.other END AS form,
         CASE WHEN top.n >= 10 * w.n THEN top.n END AS form_n FROM w LEFT JOIN best USING (word)
), r AS (
  SELECT word, word AS root, 0 AS depth FROM f
  UNION ALL SELECT r.word, f.form, depth + 1 FROM r JOIN f ON r.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, form, root, f.n, n_near, form_n FROM f JOIN (SELECT word, arg_max(root, depth) AS root FROM r GROUP BY word) USING (word)
"""


@query("op12_spelling_variants", OP12_SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


OP13_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, q.rid AS qrid, c.vec_id,
         list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, (row_number() OVER (PARTITION BY qrid ORDER BY score DESC, vec_id NULLS LAST))::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op13_exact_topk", OP13_SQL)
def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk_search.top_k(rows, rows.where(F.col("vec_id") % 50 == 0))
