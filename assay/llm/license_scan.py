"""License detection by ordered signature rules, in DataFrame functions alone.

A text that has none of a few stems and names is done at once. The words of the others are lined up, one space between them, and
each rule whose keyword is among them is tried. Detections overlap: one whose words lie within those of a stronger one
(higher rank, or longer at the same rank, or earlier in the rules) is suppressed. Everything happens in the row of the
document, so nothing is shuffled and no document meets another.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import NAMES, STEMS, rules

#: Words: runs of ASCII letters and digits and of anything beyond ASCII. (The second is for text before lower-casing.)
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrases that are always reported, with their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Score by the rank of the best detection.
SCORES = {1: 0.4, 2: 0.7, 3: 0.9, 4: 1.0}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _whole(pattern: str) -> str:
    return f"(?<![^ ])(?:{pattern})(?![^ ])"


def _places(pattern: str) -> str:
    """SQL: array of (first, last) word indexes of all matches of a pattern (an SQL expression) in `line`."""
    marked = f"split(regexp_replace(line, {pattern}, '\\u0001$0\\u0002'), ' ')"
    index = "filter(transform({w}, (x, i) -> if({test}, i, -1)), i -> i >= 0)"
    first = index.format(w=marked, test="startswith(x, '\\u0001')")
    last = index.format(w=marked, test="endswith(x, '\\u0002')")
    return f"zip_with({first}, {last}, (a, b) -> named_struct('first', a, 'last', b))"


@cache
def _rule_array() -> str:
    items = ", ".join(
        f"named_struct('n', {n}, 'label', {_quoted(a)}, 'rank', {b}, 'keyword', {_quoted(c)}, 'pattern', {_quoted(_whole(d))})"
        for n, (a, b, c, d) in enumerate(rules()))
    return f"array({items})"


def _detections() -> Column:
    tried = f"filter({_rule_array()}, r -> contains(line, r.keyword))"
    each = f"transform({tried}, r -> transform({_places('r.pattern')}, p -> named_struct('first', p.first, 'last', p.last, 'rank', r.rank, 'n', r.n, 'label', r.label)))"
    return F.expr(f"flatten({each})")


def _kept(found: str) -> Column:
    """Detections that no stronger one contains."""
    stronger = (
        "(e.rank > d.rank or (e.rank = d.rank and (e.last - e.first > d.last - d.first"
        " or (e.last - e.first = d.last - d.first and e.n < d.n))))")
    return F.expr(f"filter({found}, d -> not exists({found}, e -> e.first <= d.first and e.last >= d.last and {stronger}))")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections; one row per row.

    detections: (label, rank, first, last), words from 0, last included. n_base counts the places of the base phrases,
    first_word and last_word are the smallest and largest start of one, null without any. Labels are distinct, sorted
    and joined by commas; without any they are empty and the score is 0. A null text is empty. Rows are scanned alone,
    so repeated rows and null ids are like others; an empty table gives none; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    gate = F.col("text").rlike("(?i)" + "|".join(STEMS + NAMES))
    line = F.trim(F.regexp_replace(F.translate(F.col("text"), _UPPER, _LOWER), BREAKS, " "))
    rows = rows.select(
        "doc_id", F.regexp_count("text", F.lit(ANY_WORD)).cast("long").alias("n_words"),
        F.when(gate, line).alias("line"))
    base = ", ".join(
        f"transform(if(contains(line, {_quoted(phrase)}), {_places(_quoted(_whole(phrase)))}, array()), "
        f"p -> named_struct('first', p.first, 'label', {_quoted(label)}))" for phrase, label in BASE)
    rows = rows.withColumns({
        "base": F.when(F.col("line").isNotNull(), F.expr(f"concat({base})")),
        "found": F.when(F.col("line").isNotNull(), _detections()),
    }).withColumn("kept", F.when(F.size("found") > 0, _kept("found")))
    starts = F.transform("base", lambda p: p["first"])
    names = lambda c: F.coalesce(F.transform(c, lambda p: p["label"]), F.array().cast("array<string>"))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    best = F.coalesce(F.array_max(F.transform("kept", lambda p: p["rank"])), F.when(F.size("base") > 0, F.lit(2)))
    score = F.coalesce(*(F.when(best == k, F.lit(v)) for k, v in SCORES.items()), F.lit(0.0))
    detections = F.transform("kept", lambda p: F.struct(p["label"].alias("label"), p["rank"].alias("rank"), p["first"].alias("first"), p["last"].alias("last")))
    return rows.select(
        "doc_id", "n_words", F.greatest(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(names("base")).alias("base_labels"), joined(F.concat(names("base"), names("kept"))).alias("labels"),
        score.alias("score"), F.coalesce(detections, F.array().cast("array<struct<label:string,rank:int,first:int,last:int>>")).alias("detections"))
