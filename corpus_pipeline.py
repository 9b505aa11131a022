"""A corpus from raw documents to packed sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a table; it is written as Parquet and read again for the next one.
All but the last return the columns of `docs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import exact_dedup, language, mixing, ngram_join, packing
from assay.llm.common import NO_ID, WHITE, keep
from assay.llm.queries import tokenizer_path


def _id(name: str = "doc_id"):
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID)).alias("stage_id")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language: those whose text is null or has no letter.

    The profiles are learned from the rows of `docs` whose lang is known, outside the held-out fold. A text with a letter
    always has a nearest profile: the cosine never rejects, and without any labelled row such texts stay as well.
    """
    names, prototypes = language.learn(docs.where(language.fold("doc_id", 4) != 2))
    return language.keep_identified(docs, names, prototypes)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of equal texts, white space apart: the one with the smallest doc_id."""
    stay = exact_dedup.exact_groups(docs).where("kept").select(_id(), F.col("text_sha256").alias("stage_sha"))
    norm = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), WHITE, " ")
    rows = docs.withColumns({"stage_id": _id(), "stage_sha": F.sha2(norm, 256)})
    rows = rows.join(stay, ["stage_id", "stage_sha"]).dropDuplicates(["stage_id", "stage_sha"])
    return rows.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (five-word n-grams, similarity 0.8): the smallest doc_id."""
    found = ngram_join.near_duplicates(docs).where("first").select(_id(), F.col("text_key").alias("stage_text"))
    rows = docs.withColumns({"stage_id": _id(), "stage_text": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    return rows.join(found.distinct(), ["stage_id", "stage_text"]).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; at the end of a source's target a document is cut."""
    return mixing.mixed_documents(docs, *mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path()).drop("ids")


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: Language profiles, shingle components and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
