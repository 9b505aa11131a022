"""Ranks and quantiles over groups of any size.

A window over a whole group puts that group into one task, and ``percentile``
keeps every distinct value of a group in one buffer.  Both stop working when a
group holds a large share of the rows.  Here values are first reduced to
(group, value, count); the counts are cut into blocks (only the balance of the
work depends on where the cuts fall, never the result); ranks are then offset
of the block + rank inside the block.

Blocks follow the data: COARSE approximate quantiles cut each group, and every
value whose hash falls on one of SPLIT cuts its part again.  A group of n
distinct values has about COARSE + n / SPLIT blocks of SPLIT values or fewer,
whatever n is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.aggregates import pearson
from assay.functions.frames import with_scalars

COARSE, SPLIT = 64, 1 << 17


def _cut_columns(value: str) -> list[Column]:
    """One row's worth of cuts: coarse quantiles, and the sampled splitters between each two of them."""
    mark = F.when(F.pmod(F.xxhash64(value), F.lit(SPLIT)) == 0, F.col(value))
    return [F.percentile_approx(value, [i / COARSE for i in range(1, COARSE)], 1000).alias("__cuts"),
            F.sort_array(F.collect_set(mark)).alias("__marks")]


def _with_parts(cuts: DataFrame) -> DataFrame:
    """Splitters by coarse block, so that a row looks at its own part only."""
    part = lambda b: F.filter("__marks", lambda m: F.size(F.filter("__cuts", lambda c: c < m)) == b)
    empty = F.size("__marks") == 0
    return cuts.withColumn("__parts", F.when(~empty, F.transform(F.sequence(F.lit(0), F.lit(COARSE)), part))).drop("__marks")


def _block_of(value: Column) -> Column:
    coarse = F.size(F.filter("__cuts", lambda c: c < value)).cast("long")
    fine = F.size(F.filter(F.get("__parts", coarse.cast("int")), lambda m: m < value))
    return coarse * (1 << 32) + F.when(F.col("__parts").isNotNull(), fine).otherwise(0)


def _with_cuts(counts: DataFrame, cuts: DataFrame, groups: list[str]) -> DataFrame:
    """Without groups the cut table is one row, a scalar."""
    return counts.join(cuts, groups) if groups else with_scalars(counts, cuts)


def _blocked_counts(df: DataFrame, groups: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """Counts per value with their block, and the offset of each block.

    Both results start from the same (groups, value, cnt) shuffle, which Spark
    runs once and reuses; ``n`` comes from the cut table so that every use
    needs the same columns of it.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*groups, value)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    cuts = _with_parts(counts.groupBy(*groups).agg(*_cut_columns(value), F.sum("cnt").alias("n")))
    blocked = _with_cuts(counts, cuts, groups).withColumn("block", _block_of(F.col(value))).drop("__cuts", "__parts")
    # one row per block from here on
    sizes = blocked.groupBy(*groups, "block", "n").agg(F.sum("cnt").alias("block_n"))
    earlier = (
        Window.partitionBy(*groups).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.withColumn("before", F.coalesce(F.sum("block_n").over(earlier), F.lit(0)))
    return blocked.drop("n"), offsets


def average_ranks(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """(groups, value, avg_rank, n): tied values share the mean of their ranks."""
    keys = groups
    inside = (
        Window.partitionBy(*keys, "block").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    lower = F.col("before") + F.coalesce(F.sum("cnt").over(inside), F.lit(0))
    blocked, offsets = _blocked_counts(df, keys, value)
    return blocked.join(offsets, [*keys, "block"]).select(
        *groups, value, (lower + (F.col("cnt") + 1) / 2).alias("avg_rank"), "n"
    )


def with_average_rank(df: DataFrame, groups: list[str], value: str, out: str) -> DataFrame:
    """Rows plus their average rank and the number of ranked rows of the group.

    The rank table has one row per distinct value, so the join back is a plain
    equi-join whose hot keys AQE can split.
    """
    ranks = average_ranks(df, groups, value).withColumnsRenamed(
        {"avg_rank": out, "n": out + "_n"}
    )
    return df.join(ranks, [*groups, value], "left")


def spearman(df: DataFrame, groups: list[str], x: str, y: str, least_rows: int = 2) -> DataFrame:
    """(groups, n, rank_ic): Pearson r of average ranks over complete pairs."""
    keys = groups
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    d = d.select(*keys, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y"))
    # both sides are ranked in one pass, as two groups of one long table
    long = d.select(*keys, F.explode(F.array(
        F.struct(F.lit("x").alias("__side"), F.col("__x").alias("__v")),
        F.struct(F.lit("y").alias("__side"), F.col("__y").alias("__v")))).alias("__e")).select(*keys, "__e.*")
    ranks = average_ranks(long, [*keys, "__side"], "__v").select(*keys, "__side", "__v", "avg_rank")
    rx = ranks.filter("__side = 'x'").select(*keys, F.col("__v").alias("__x"), F.col("avg_rank").alias("__rx"))
    ry = ranks.filter("__side = 'y'").select(*keys, F.col("__v").alias("__y"), F.col("avg_rank").alias("__ry"))
    return d.join(rx, [*keys, "__x"]).join(ry, [*keys, "__y"]).groupBy(*keys).agg(
        F.count("*").alias("n"), pearson("__rx", "__ry", least_rows).alias("rank_ic")
    ).select(*groups, "n", "rank_ic")


def exact_quantiles(
    df: DataFrame, groups: list[str], value: str, probabilities: list[float]
) -> DataFrame:
    """(groups, p, quantile): linear interpolation, as in the usual median.

    Only the blocks that hold a wanted position are looked into.
    """
    keys = groups
    blocked, offsets = _blocked_counts(df, keys, value)
    inside = Window.partitionBy(*keys, "block").orderBy(value)
    wanted = (
        offsets.withColumn("p", F.explode(F.array(*[F.lit(float(x)) for x in probabilities])))
        .withColumn("pos", F.col("p") * (F.col("n") - 1))
        .withColumn("lo", F.floor("pos"))
        .withColumn("hi", F.ceil("pos"))
        .filter(
            (F.col("hi") >= F.col("before"))
            & (F.col("lo") < F.col("before") + F.col("block_n"))
        )
    )
    # one row per wanted position and block: at most two blocks per position
    in_block = blocked.withColumn("start", F.sum("cnt").over(inside) - F.col("cnt"))
    spans = in_block.join(wanted, [*keys, "block"]).withColumn(
        "start", F.col("before") + F.col("start")).withColumn(
        "end", F.col("start") + F.col("cnt")).withColumn("v", F.col(value))
    hit = lambda k: (F.col(k) >= F.col("start")) & (F.col(k) < F.col("end"))
    return (
        spans.groupBy(*keys, "p", "pos", "lo")
        .agg(
            F.max(F.when(hit("lo"), F.col("v"))).alias("v_lo"),
            F.max(F.when(hit("hi"), F.col("v"))).alias("v_hi"),
        )
        .select(
            *groups,
            "p",
            (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("pos") - F.col("lo"))).alias(
                "quantile"
            ),
        )
    )


def numbered_by_id(df: DataFrame, id_col: str, out: str = "row_no") -> DataFrame:
    """Global 0-based row number in the order of a unique id, dense or sparse.

    Rows are cut into blocks of ids as above and numbered inside their block;
    the only single-task step adds up the block sizes.
    """
    cuts = _with_parts(df.agg(*_cut_columns(id_col)))
    d = with_scalars(df, cuts).withColumn("__blk", _block_of(F.col(id_col))).drop("__cuts", "__parts")
    sizes = d.groupBy("__blk").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__blk",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
        F.sum("__n").over(Window.partitionBy(F.lit(0))).alias(out + "_total"),
    )
    inside = Window.partitionBy("__blk").orderBy(id_col)
    return (
        d.join(offsets, "__blk")
        .withColumn(out, F.col("__off") + F.row_number().over(inside) - 1)
        .drop("__blk", "__off")
    )
