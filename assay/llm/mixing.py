"""Mixing of sources to target weights by a low-discrepancy schedule.

The words of a source, its documents in hashed order, form a stream that is cut into equal blocks. Targets say how many
words of each stream the mix takes. Every source gets as many slots as its target needs blocks, as a range of integers;
slot t of the mix belongs to the source whose range holds the van der Corput point of t (its bits reversed), so every
stretch of the mix holds the sources in nearly their target shares. The r-th slot of a source takes the r-th block of
its stream, starting over at the end, and only its target's worth of the last one.

Nothing is ordered over a whole source in one task: positions and ranks are prefix sums in two levels, over hash
buckets (or runs of slots) and inside one bucket.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, WORD, keep, power_of_two, words_of

#: Weights of the sources by order of name, repeating; share of all words that the mix has; most repeats of a source.
WEIGHTS, SHARE, REPEATS = (3, 1, 2), 1.5, 2
#: Documents in one bucket of the hashed order, slots in one run, slots that one task makes.
BUCKET_DOCS, RUN_SLOTS, CHUNK_SLOTS = 4096, 1 << 14, 1 << 16


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source, so windows over all stay small.

    Filling by weight: sources whose limit (`repeats` times their size) is low for their weight reach it first; the
    level of the rest is what is left, per weight. Where no source is left, the limits are the targets.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    w = w.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    w = w.withColumn("limit", F.lit(repeats) * F.col("source_size"))
    filled = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    w = w.withColumns({
        "before": F.coalesce(F.sum("limit").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "left": F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)),
        "words": F.sum("source_size").over(everything),
    })
    w = w.withColumn("level", (F.lit(share) * F.col("words") - F.col("before")) / F.col("left"))
    # The first source in filling order whose limit is above its level sets the level of it and all later ones.
    fits = F.col("level") * F.col("weight") <= F.col("limit")
    w = w.withColumn("final", F.first(F.when(fits, F.col("level")), ignorenulls=True).over(
        filled.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.coalesce(F.col("final") * F.col("weight"), F.col("limit").cast("double"))
    return w.select("source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


def _before(df: DataFrame, value: str, bucket: list[str], inside: list[str], group: list[str], out: str) -> DataFrame:
    """Sum of `value` over the rows before, in the order (bucket, inside) of each group, as column `out`."""
    totals = df.groupBy(*group, *bucket).agg(F.sum(value).alias("total"))
    over = Window.partitionBy(*group).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("base", F.coalesce(F.sum("total").over(over), F.lit(0))).drop("total")
    totals = totals.withColumnsRenamed({c: f"{c}_of_total" for c in [*group, *bucket]})
    near = Window.partitionBy(*group, *bucket).orderBy(*inside).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("near", F.coalesce(F.sum(value).over(near), F.lit(0)))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_of_total")) for c in [*group, *bucket]]
    return df.join(totals, functools.reduce(lambda a, b: a & b, same)).select(
        *(c for c in df.columns if c != "near"), (F.col("near") + F.col("base")).alias(out))


def stream(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """(doc_id, source, size, text_key, position): every document's place, in words, in the hashed order of its source."""
    ordering = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("size").cast("string")))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        n_words(F.col(text_col)).alias("size"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
    ).withColumn("ordering", ordering)
    rows = keep(rows)
    buckets = power_of_two(rows.count() / BUCKET_DOCS)
    rows = rows.withColumn("bucket", F.conv(F.substring("ordering", 1, 8), 16, 10).cast("long") % buckets)
    return _before(rows, "size", ["bucket"], ["ordering", "doc_id", "text_key"], ["source"], "position").drop("bucket", "ordering")


def schedule(sources: DataFrame, block_words: int) -> DataFrame:
    """(slot, source, block, pass, first, last): the blocks in order of the mix, and the words of its source's stream.

    `sources`: (source, source_size, target). Slots that no source owns are left out, so slot numbers have gaps.
    """
    take = F.least(F.floor("target").cast("long"), F.col("source_size") * REPEATS)
    need = (
        (take / F.greatest("source_size", F.lit(1))).cast("long") * F.ceil(F.col("source_size") / block_words)
        + F.ceil(F.pmod(take, F.greatest("source_size", F.lit(1))) / block_words)
    ).cast("long")
    s = sources.withColumn("take", take).withColumn("slots", need).where("slots > 0")
    order = Window.orderBy(F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("begin", F.coalesce(F.sum("slots").over(order), F.lit(0)))
    total = s.agg(F.sum("slots")).first()[0] or 0
    bits = max(1, (total - 1).bit_length() if total else 1)
    # One row per slot: chunks first, so that the slots of a large source are made by many tasks.
    s = s.withColumn("chunk", F.explode(F.sequence(F.lit(0), ((F.col("slots") - 1) / CHUNK_SLOTS).cast("long"))))
    s = s.repartition(max(1, total // CHUNK_SLOTS + 1), "source", "chunk")
    last = F.least(F.col("slots"), (F.col("chunk") + 1) * CHUNK_SLOTS) - 1
    s = s.withColumn("point", F.explode(F.sequence(F.col("chunk") * CHUNK_SLOTS + F.col("begin"), last + F.col("begin"))))
    s = s.withColumn("slot", F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long"))
    s = s.withColumns({"run": F.floor(F.col("slot") / RUN_SLOTS), "one": F.lit(1)})
    s = _before(s, "one", ["run"], ["slot"], ["source"], "rank")
    blocks = F.ceil(F.col("source_size") / block_words)
    s = s.withColumns({"block": F.pmod("rank", blocks), "pass": (F.col("rank") / blocks).cast("long")})
    first = F.col("block") * block_words
    upto = F.least(first + block_words, F.col("source_size"), F.col("take") - F.col("pass") * F.col("source_size"))
    return s.select("slot", "source", "block", "pass", first.alias("first"), upto.alias("last")).where("last > first")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_words: int = 1024,
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """The mix as (places, pieces).

    places: (doc_id, source, size, text_key, position, source_size, target), one row per document.
    pieces: (slot, pass, source, position, doc_id, first_word, last_word), the words [first_word, last_word) of a
    document that a slot takes; `source` and `position` name the document's place.
    A null source is a source of its own, the last; a null or empty text has no words and is never taken. Rows that
    occur twice are two documents. Null ids are documents like others. An empty table gives empty results.
    """
    if repeats > REPEATS:
        raise ValueError(f"a source is taken at most {REPEATS} times")
    places = keep(stream(docs, id_col, text_col, source_col, seed))
    sources = source_targets(places.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats)
    sources = keep(sources)
    p = places.join(sources, places["source"].eqNullSafe(sources["source"])).select(places["*"], "source_size", "target")
    cut = places.where("size > 0").withColumn("block", F.explode(F.sequence(
        (F.col("position") / block_words).cast("long"), ((F.col("position") + F.col("size") - 1) / block_words).cast("long"))))
    slots = schedule(sources, block_words)
    pieces = cut.join(slots, cut["source"].eqNullSafe(slots["source"]) & (cut["block"] == slots["block"])).select(
        "slot", "pass", cut["source"], "position", "doc_id",
        (F.greatest("first", "position") - F.col("position")).alias("first_word"),
        (F.least("last", F.col("position") + F.col("size")) - F.col("position")).alias("last_word"),
    ).where("last_word > first_word")
    return p, pieces


def mix_report(places: DataFrame, pieces: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: how many of a document's words the mix takes, repeats counted."""
    taken = pieces.groupBy(F.col("source").alias("of_source"), F.col("position").alias("at")).agg(
        F.sum(F.col("last_word") - F.col("first_word")).alias("taken"))
    own = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("position") == F.col("at")) & (F.col("size") > 0)
    return places.join(taken, own, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, places: DataFrame, pieces: DataFrame) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with all their columns; text holds the words that it takes.

    A document taken whole keeps its text; one cut at the end of its source's target keeps its first words, joined by
    one space. n_chars, where there is such a column, follows the text. `docs` has columns doc_id, text and source.
    """
    taken = pieces.groupBy(F.col("source").alias("of_source"), F.col("position").alias("at"), "pass").agg(
        F.min("first_word").alias("from_word"), F.max("last_word").alias("to_word"))
    on_place = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("position") == F.col("at")) & (F.col("size") > 0)
    key = {
        "mix_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
        "mix_source": F.struct(F.col("source").cast("string").alias("s")),
    }
    taken = places.join(taken, on_place).withColumns(key).select(
        *key, F.col("text_key").alias("mix_text"), F.col("position").alias("mix_at"), F.col("pass").alias("mix_pass"),
        "from_word", "to_word", F.col("size").alias("mix_size"))
    rows = docs.withColumns(key | {"mix_text": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    on = [*key, "mix_text"]
    # A row that `docs` has twice has two places; each place yields one row.
    rows = rows.join(taken, on).dropDuplicates([*on, "mix_at", "mix_pass"])
    whole = (F.col("from_word") == 0) & (F.col("to_word") == F.col("mix_size"))
    part = F.array_join(F.slice(words_of(F.col("text")), (F.col("from_word") + 1).cast("int"), (F.col("to_word") - F.col("from_word")).cast("int")), " ")
    rows = rows.withColumn("text", F.when(whole, F.col("text")).otherwise(part))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return rows.select(docs.columns)
