"""Exact deduplication with counting quotient filters.

Every partition builds counting quotient filters of its 64-bit text fingerprints: the quotient (the high bits) names a
block, and a block holds sorted remainders with their counts. Filters of all partitions merge block by block by their
sorted remainders, without loss, into one count per fingerprint. A fingerprint counted once has no copy, so its text
never moves again. Texts of the others go to byte verification: they are grouped by the bytes themselves, with partial
counts on the map side, so a group of any number of copies travels as one row per partition. Rows meet the results of
their group where they are if the group is large: there are few large groups, and those are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, join_hot, keep, power_of_two

FILTER_ROWS = 1 << 20
FILTER = pa.schema([("block", pa.int64()), ("remainders", pa.binary()), ("counts", pa.binary())])


def _filters(blocks: int, shift: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counting quotient filters of at most FILTER_ROWS fingerprints each, a row per block."""
    rest, have = [], 0

    def build() -> pa.RecordBatch:
        prints, counts = np.unique(np.concatenate(rest), return_counts=True)
        block = (prints >> np.uint64(shift)).astype(np.int64) if blocks > 1 else np.zeros(len(prints), np.int64)
        ids, first = np.unique(block, return_index=True)
        cuts = [*first, len(prints)]
        return pa.RecordBatch.from_arrays([
            pa.array(ids),
            pa.array([prints[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            pa.array([counts[a:b].astype(np.int64).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        ], schema=FILTER)

    for batch in batches:
        rest.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        have += len(rest[-1])
        if have >= FILTER_ROWS:
            yield build()
            rest, have = [], 0
    if have:
        yield build()


def _merge(group: pa.Table) -> pa.Table:
    """Merge the filters of one block by sorted remainders; return the fingerprints counted more than once."""
    prints = np.concatenate([np.frombuffer(x, np.uint64) for x in group.column("remainders").to_pylist()])
    counts = np.concatenate([np.frombuffer(x, np.int64) for x in group.column("counts").to_pylist()])
    order = np.argsort(prints, kind="stable")
    prints = prints[order]
    first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
    total = np.add.reduceat(counts[order], first)
    many = total > 1
    return pa.table({"print": prints[first][many].view(np.int64), "copies": total[many]})


def repeated_fingerprints(prints: DataFrame, rows: int) -> DataFrame:
    """(print, copies) of the fingerprints that occur more than once in the one-column table `prints`."""
    blocks = power_of_two(max(rows / (FILTER_ROWS // 4), 64))
    shift = 64 - int(np.log2(blocks))
    filters = prints.mapInArrow(lambda it: _filters(blocks, shift, it), "block long, remainders binary, counts binary")
    return filters.groupBy("block").applyInArrow(_merge, "print long, copies long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", print_bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, text_size (bytes of the normalised text).

    Texts are equal when identical after every run of ASCII white space became one space; null counts as empty. Of equal
    texts the row with the smallest id stays; null ids come last, and of rows that also share the id one stays. An
    empty table gives an empty result. Other columns of `docs` are not read. `print_bits` below 64 only adds work for
    the byte verification (tests use it to provoke collisions).
    """
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WHITE, " ")
    print_ = F.xxhash64("norm")
    if print_bits < 64:
        print_ = print_.bitwiseAND(F.lit(-(1 << (64 - print_bits))))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm"))
    rows = keep(base.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), print_.alias("print"),
        F.sha2("norm", 256).alias("text_sha256"), F.octet_length("norm").cast("long").alias("text_size"),
    ))
    total = rows.count()
    repeated = keep(repeated_fingerprints(rows.select("print"), total))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"))
    copies = keep(
        join_hot(base.withColumn("print", print_), repeated, ["print"], "copies", total)
        .groupBy("print", "norm").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1")
        .select("print", F.sha2("norm", 256).alias("text_sha256"), F.col("first.doc_id").alias("first_id"), "size")
    )
    # Rows that share text and smallest id: the first of them stays.
    same = ["print", "text_sha256"]
    stay = (
        join_hot(rows, copies, same, "size", total).where(F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy(*same).agg(F.min("row").alias("stay"))
    )
    copies = keep(copies.join(stay, same, "left"))
    return join_hot(rows, copies, same, "size", total, "left").select(
        "doc_id", F.when(F.col("size").isNotNull(), F.col("first_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("stay"), F.lit(True)).alias("kept"), "text_sha256", "text_size",
    )
