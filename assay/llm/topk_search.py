"""Exact top-k inner products with an impact-ordered index that is read score at a time.

Vectors with integer components are cut into shards. The index of a shard holds, for every dimension, the vectors in
order of their component, cut into segments of nearly equal components (the quantised impacts). A query turns each
segment into the most that it can add to a score above the least of its dimension, quantises these to whole steps, and
adds them to the accumulators in falling order. What a vector can still gain is the next step for each dimension not yet
seen; the exact scores of the vectors that lead so far give a threshold. Once few enough vectors can reach the threshold
the rest is proven out, and the possible members are scored exactly. Nothing depends on a guess: where no proof comes,
all segments are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, keep

#: Components of one shard of the index, and segments of a dimension in it.
SHARD = 1 << 20
SEGMENTS = 32
#: The highest quantised impact of a query.
STEPS = 1023
#: Components at or above this size would leave 64 bits in the sum of a product.
LARGEST = 2.0**20

INDEX = "shard long, dims long, members binary, segments binary, vectors binary, n_ids binary, ids binary"


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(vec_id, vec) with floor(scale * component) in doubles; only vectors whose components all have a value take part."""
    vec = F.col(vec_col)
    valid = F.coalesce(F.forall(vec, lambda x: F.coalesce(F.abs(x.cast("double")) < LARGEST, F.lit(False))), F.lit(False))
    whole = F.transform(vec, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("int"))
    return rows.where(valid).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("vec"))


def distinct_vectors(rows: DataFrame, n_ids: int) -> DataFrame:
    """(vec, ids): each distinct vector once, with its n_ids smallest ids (null as NO_ID, last).

    No more of them can be among the best n_ids of any query. Copies of one vector are cut per task first (a limit that
    Spark puts below the shuffle), then in 32 parts, then together, so a crowd of copies meets in no task.
    """
    rows = rows.select("vec", F.coalesce("vec_id", F.lit(NO_ID)).alias("id")).withColumn("part", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(32)))
    for by in (["vec", "part"], ["vec"]):
        rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).where(F.col("place") <= n_ids)
    return rows.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))


# ---------------------------------------------------------------- one shard


def _matrix(vecs: pa.Array, dims: int | None = None) -> np.ndarray:
    """Lists of integers as rows of a matrix; short ones end in zeros, and dims cuts or pads all."""
    sizes = vecs.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    dims = int(sizes.max(initial=0)) if dims is None else dims
    values = vecs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((len(sizes), dims), np.int64)
    fits = column < dims
    out[row[fits], column[fits]] = values[fits]
    return out


def _index(table: pa.Table) -> pa.Table:
    """The index of one shard as a row of packed arrays."""
    vectors = _matrix(table.column("vec").combine_chunks())
    ids = table.column("ids").combine_chunks()
    n, dims = vectors.shape
    members, segments = np.zeros((dims, n), np.uint32), []
    for d in range(dims):
        values = vectors[:, d]
        low, high = int(values.min()), int(values.max())
        level = (values - low) // max(1, -(-(high - low + 1) // SEGMENTS))
        order = np.argsort(level, kind="stable")
        members[d] = order
        ends = np.flatnonzero(np.diff(level[order], append=-1)) + 1
        for a, b in zip([0, *ends[:-1]], ends):
            part = values[order[a:b]]
            segments.append((d, a, b, part.min(), part.max()))
    return pa.table({
        "shard": [table.column("shard")[0].as_py()], "dims": [dims], "members": [members.tobytes()],
        "segments": [np.array(segments, np.int64).reshape(-1, 5).tobytes()], "vectors": [vectors.astype(np.int32).tobytes()],
        "n_ids": [ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32).tobytes()],
        "ids": [ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64).tobytes()],
    })


class Shard:
    """An index row unpacked for searching."""

    def __init__(self, row: dict):
        self.dims = row["dims"]
        self.n_ids = np.frombuffer(row["n_ids"], np.int32).astype(np.int64)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.first = np.cumsum(self.n_ids) - self.n_ids
        self.n = len(self.n_ids)
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(self.n, self.dims).astype(np.int64)
        self.members = np.frombuffer(row["members"], np.uint32).reshape(self.dims, self.n).astype(np.int64)
        self.segments = np.frombuffer(row["segments"], np.int64).reshape(-1, 5).T
        self.unit = 1 << self.dims.bit_length()  # steps lie above a count of the dimensions seen
        self.read = 0.0  # share of the postings read by the last search

    def possible(self, query: np.ndarray, k: int) -> np.ndarray:
        """Rows of the shard outside which no vector is among the k best: no vector left out reaches the k-th score."""
        if not self.dims or self.n <= k:
            return np.arange(self.n)
        d, begin, end, low, high = self.segments
        most, least = np.maximum(query[d] * low, query[d] * high), np.minimum(query[d] * low, query[d] * high)
        floor = np.full(self.dims, np.iinfo(np.int64).max)
        np.minimum.at(floor, d, least)
        most = most - floor[d]
        step = max(1, -(-int(most.max()) // STEPS))
        impact = -(-most // step)
        order = np.argsort(-impact, kind="stable")
        size = (end - begin)[order]
        reached = np.cumsum(size)
        sums, at, threshold = np.zeros(self.n), 0, None
        enough, batch = max(64, self.n // 8), 12 * self.n
        while True:
            stop = min(int(np.searchsorted(reached, (reached[at - 1] if at else 0) + batch)) + 1, len(order))
            part = order[at:stop]
            rows = np.concatenate([self.members[d[i], begin[i] : end[i]] for i in part])
            sums += np.bincount(rows, np.repeat(impact[part] * float(self.unit) + 1, size[at:stop]), self.n)
            at = stop
            steps = np.floor(sums / self.unit)
            seen = sums - steps * self.unit
            leaders = np.argpartition(-steps, min(4 * k, self.n - 1))[: 4 * k]
            best = np.sort(self.vectors[leaders] @ query)[-k]
            threshold = best if threshold is None else max(threshold, best)
            ahead = impact[order[at]] if at < len(order) else 0
            left = np.flatnonzero((steps + (self.dims - seen) * ahead) * step >= threshold - int(floor.sum()))
            if len(left) <= enough or at == len(order):
                self.read = reached[at - 1] / (self.n * self.dims)
                return left

    def best(self, query: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, scores and whether the row is the query's own, of the k best rows: by score, then the smaller id."""
        rows = self.possible(query, k)
        score = self.vectors[rows] @ query
        if len(rows) > k:
            stay = score >= np.partition(score, len(rows) - k)[len(rows) - k]
            rows, score = rows[stay], score[stay]
        n = self.n_ids[rows]
        ids = self.ids[np.repeat(self.first[rows], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        same = np.repeat((self.vectors[rows] == query).all(axis=1), n)
        score = np.repeat(score, n)
        order = np.lexsort((ids, -score))[:k]
        return ids[order], score[order], (same & (ids == query_id))[order]


def _search(k: int):
    """Rows sorted by shard, the index of each before its queries: one index is held at a time, queries pass by."""

    def run(batches: Iterator[pa.RecordBatch]):
        shard = None
        for batch in batches:
            kind = batch.column("q").is_null().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(kind | np.append(True, kind[:-1]))
            for a, b in zip(cuts, np.append(cuts[1:], len(kind))):
                if kind[a]:
                    shard = Shard(batch.slice(a, 1).to_pylist()[0])
                    continue
                part = batch.slice(a, b - a)
                queries = _matrix(part.column("vec"), shard.dims)
                whole = part.column("vec").value_lengths().to_numpy(zero_copy_only=False)
                out: dict[str, list] = {"q": [], "vec_id": [], "score": [], "own": []}
                for i, (q, query_id) in enumerate(zip(part.column("q").to_pylist(), part.column("query_id").to_pylist())):
                    ids, score, own = shard.best(queries[i], query_id, k)
                    out["q"].append(np.full(len(ids), q))
                    out["vec_id"].append(ids)
                    out["score"].append(score)
                    # A query longer than the shard's vectors is none of them.
                    out["own"].append(own & (whole[i] <= shard.dims))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in out.values()], list(out))

    return run


# ---------------------------------------------------------------- all shards


def build_index(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The index of all `vectors` (vec, ids) as one row per shard, written; and the number of shards."""
    components = vectors.agg(F.sum(F.greatest(F.size("vec"), F.lit(1)))).first()[0] or 0
    shards = -(-components // SHARD)
    rows = vectors.withColumn("shard", F.pmod(F.xxhash64("vec"), F.lit(max(shards, 1))))
    return keep(rows.groupBy("shard").applyInArrow(_index, INDEX)), shards


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of `queries` its k best rows of `rows` by integer inner product.

    A query's own row (one row with its id and its vector) is no candidate; other rows with the same id are. Equal scores
    go to the smaller id, null ids last. A query with fewer than k candidates returns all of them. Vectors that are null,
    or hold a null, NaN, infinite or too large component (LARGEST, 2**20), take no part on either side. Where lengths
    differ, the missing components count as 0. Repeated rows are candidates each; a repeated query returns its rows again.
    Other columns are not read, whatever their names.
    """
    k_own = k + 1  # the own row may be among the best
    index, shards = build_index(keep(distinct_vectors(integer_vectors(rows, id_col, vec_col, scale), k_own)))
    asked = integer_vectors(queries, id_col, vec_col, scale).groupBy(F.col("vec_id").alias("query_id"), "vec").agg(F.count("*").alias("copies"))
    asked = keep(asked.withColumn("q", F.monotonically_increasing_id()))
    if not shards:
        return asked.where("false").selectExpr("query_id", "cast(0 as int) AS rank", "q AS vec_id", "q AS score")
    sent = asked.select(F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard"), "q", F.coalesce("query_id", F.lit(NO_ID)).alias("query_id"), "vec")
    both = index.unionByName(sent, allowMissingColumns=True).repartition(shards, "shard").sortWithinPartitions("shard", F.asc_nulls_first("q"))
    found = both.mapInArrow(_search(k_own), "q long, vec_id long, score long, own boolean")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("place", place).where(F.col("place") <= k_own)
    nth_own = F.sum(F.col("own").cast("int")).over(Window.partitionBy("q").orderBy("place"))
    found = found.withColumn("nth_own", nth_own).where(~(F.col("own") & (F.col("nth_own") == 1)))
    rank = F.row_number().over(Window.partitionBy("q").orderBy("place"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    found = found.join(asked.select("q", "query_id", "copies"), "q")
    return found.select(
        "query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")
