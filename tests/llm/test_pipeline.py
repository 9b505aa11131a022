"""The stages of the corpus pipeline against brute force."""

from __future__ import annotations

import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assay.llm import mixing
from assay.llm.common import keep

from .test_operators import brute_components, texts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    rows = [(*r, len(r[1] or ""), "extra") for r in texts()]
    out = [keep(spark.createDataFrame(rows, SCHEMA).repartition(3))]
    for _, stage in corpus_pipeline.STAGES:
        out.append(keep(stage(spark, out[-1], "")))
    return out


def listed(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_columns(steps):
    assert [s.columns for s in steps[1:-1]] == [steps[0].columns] * 4
    assert len(corpus_pipeline.STAGES) == 5


def test_language_rejects_texts_without_letters(steps):
    assert Counter(listed(steps[1], "doc_id", "text")) == Counter(
        (i, t) for i, t in listed(steps[0], "doc_id", "text") if t and any(c.isalpha() for c in t))


@pytest.mark.parametrize("lang", ["null", "if(pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2, 'en', null)"])
def test_language_keeps_texts_of_an_unlabelled_input(spark, steps, lang):
    out = corpus_pipeline.identify_language(spark, steps[0].withColumn("lang", F.expr(lang).cast("string")), "")
    assert Counter(listed(out, "doc_id", "text")) == Counter(listed(steps[1], "doc_id", "text"))


def test_exact_copies_go(steps):
    first = {}
    for i, t in listed(steps[1], "doc_id", "text"):
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        first[norm] = min(first.get(norm, (True, 0)), (i is None, i or 0))
    assert sorted((i is None, i or 0) for (i,) in listed(steps[2], "doc_id")) == sorted(first.values())


def test_near_copies_go(steps):
    rows = [(i, t) for i, t in listed(steps[2], "doc_id", "text")]
    groups = {c for _, _, c in brute_components(rows, 5, Fraction(8, 10))}
    kept = Counter(i for (i,) in listed(steps[3], "doc_id"))
    components = brute_components(rows, 5, Fraction(8, 10))
    assert set(kept) == groups
    assert sum(kept.values()) <= sum(n for (i, _, c), n in components.items() if i == c)


def test_mix_takes_its_words(steps):
    words = lambda df: df.agg(F.sum(mixing.n_words(F.col("text")))).first()[0]
    sources = steps[3].select("source").distinct().count()
    assert 0 <= 1.5 * words(steps[3]) - words(steps[4]) <= sources + 1


def test_packing_holds_every_document(steps):
    packed = steps[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.sum(F.when(F.col("start") == 0, F.col("doc_tokens"))).alias("tokens"))
    assert packed.where("n <> tokens").count() == 0
    assert steps[5].where("start = 0").count() == steps[4].count()


def test_empty_table(spark, steps):
    docs = steps[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, ""))
    assert docs.count() == 0
