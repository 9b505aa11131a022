"""Target-distribution importance resampling: draw the documents whose word n-grams look most like a target set.

Three steps. Every feature (a run of one to three words) falls into one of a fixed number of buckets; two passes of
whole texts count the buckets of the corpus and of the target, and an array of one gain per bucket scores all documents.
A document's key is its weight plus Gumbel noise that a hash of its id fixes, so the highest keys are a draw without
replacement. The cut-off key is found by weighted medians of medians: every group of remaining keys reports its median
and its size, the weighted median of these is the next pivot, and what lies on the wrong side of it (a quarter at least)
is done with. Only the keys above the cut-off are sorted, by ranges, and ranked.

The CRC of a feature comes from the CRCs of its words: a CRC register runs over further bytes as a linear map, so the
bytes of a word are read once and two- and three-word runs are combined by table look-ups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _LOWER, NO_ID, chunks, keep, raw

#: Words after lower-casing A-Z are runs of digits, letters a-z and everything outside ASCII.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
#: Bytes of text taken at a time; longer texts are read in pieces of this size.
CHUNK = 4 << 20
#: Keys of one group, each of which reports one median; remaining keys that are sorted at once to end the search.
GROUP = 1 << 20
FINISH = 4096

# ---------------------------------------------------------------- checksums of word runs

_SHORT = 33


def _crc_table() -> np.ndarray:
    reg = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        reg = (reg >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (reg & np.uint32(1)))
    return reg


def _through(maps: np.ndarray, at: np.ndarray | int, reg: np.ndarray) -> np.ndarray:
    """Registers sent through the linear maps numbered `at`, each map four tables of 256 entries."""
    flat = maps.ravel()
    base = np.asarray(at, np.int64) * 1024
    out = flat[base + (reg & np.uint32(255))]
    for k in (1, 2, 3):
        out ^= flat[base + k * 256 + ((reg >> np.uint32(8 * k)) & np.uint32(255))]
    return out


class _Checksum:
    """Registers of CRC-32 advanced by bytes, and by any number of bytes that follow."""

    def __init__(self):
        self.table = _crc_table()
        unit = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
        near = [unit]
        for _ in range(_SHORT):
            near.append(self.table[near[-1] & np.uint32(255)] ^ (near[-1] >> np.uint32(8)))
        self.near = np.stack(near)  # by n zero bytes, n <= _SHORT
        far = [self.near[1]]
        for _ in range(39):
            far.append(_through(far[-1][None], 0, far[-1]))
        self.far = np.stack(far)  # by 2**k zero bytes

    def advance(self, reg: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The registers after n zero bytes each."""
        out = _through(self.near, np.minimum(n, _SHORT), reg)
        for i in np.flatnonzero(n > _SHORT):
            one, rest = reg[i : i + 1], int(n[i])
            for k in range(rest.bit_length()):
                if rest >> k & 1:
                    one = _through(self.far, k, one)
            out[i] = one[0]
        return out

    def words(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The register of each word, begun at 0."""
        reg = np.zeros(len(starts), np.uint32)
        order = np.argsort(-sizes, kind="stable")
        begin, size = starts[order], sizes[order]
        long = int(np.searchsorted(-size, -_SHORT, side="left"))
        part = np.zeros(len(starts) - long, np.uint32)
        begin, size = begin[long:], size[long:]
        for k in range(int(size[0]) if len(size) else 0):
            m = int(np.searchsorted(-size, -k, side="left"))
            part[:m] = self.table[(part[:m] ^ data[begin[:m] + k]) & np.uint32(255)] ^ (part[:m] >> np.uint32(8))
        reg[order[long:]] = part
        for i in order[:long]:
            reg[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]], 0xFFFFFFFF) ^ 0xFFFFFFFF
        return reg


def run_buckets(data: np.ndarray, offsets: np.ndarray, n_buckets: int, sums: _Checksum) -> tuple[np.ndarray, list[np.ndarray]]:
    """Index of each text's first word, and by length (1 to 3) the bucket of the run that ends at each word, else -1."""
    inside, data = _WORD[data], _LOWER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    left, right = np.ones(len(data), bool), np.ones(len(data), bool)
    left[1:], right[:-1] = ~inside[:-1], ~inside[1:]
    starts = np.flatnonzero(inside & (left | edge[:-1]))
    sizes = np.flatnonzero(inside & (right | edge[1:])) + 1 - starts
    first = np.searchsorted(starts, offsets)
    own = sums.words(data, starts, sizes)
    reg = sums.advance(np.full(len(own), 0xFFFFFFFF, np.uint32), sizes) ^ own
    spaced = sums.advance(np.full(len(own), sums.table[32], np.uint32), sizes) ^ own  # of a space and the word
    place = np.arange(len(own)) - np.repeat(first[:-1], np.diff(first))
    out = []
    for n in range(3):
        if n and len(own):
            reg = np.append(np.uint32(0), sums.advance(reg[:-1], sizes[1:] + 1) ^ spaced[1:]).astype(np.uint32)
        out.append(np.where(place >= n, ((reg ^ np.uint32(0xFFFFFFFF)) % np.uint32(n_buckets)).astype(np.int64), -1))
    return first, out


def _pieces(data: np.ndarray) -> Iterator[tuple[np.ndarray, int, bool]]:
    """A long text in pieces cut between words: the bytes, how many words of the piece before they begin with, the end."""
    at, carried, back = 0, 0, 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data) and _WORD[data[end]]:
            stop = np.flatnonzero(~_WORD[data[end : end + CHUNK]])
            end = end + int(stop[0]) if len(stop) else min(end + CHUNK, len(data))
        yield data[back:end], carried, end == len(data)
        reach = 256
        while True:  # where the last two words begin
            low = max(back, end - reach)
            inside = _WORD[data[low:end]]
            begins = np.flatnonzero(inside & ~np.append(low > 0 and bool(_WORD[data[low - 1]]), inside[:-1]))[-2:]
            if len(begins) == 2 or low == back:
                break
            reach *= 4
        carried, back, at = (len(begins), low + int(begins[0]), end) if len(begins) else (0, end, end)


def _runs(batches, text_col: str, n_buckets: int) -> Iterator[tuple[pa.Table, np.ndarray, list[np.ndarray], bool]]:
    """(rows, index of each row's first word, buckets by run length, whether the row is complete); long texts in pieces."""
    sums = _Checksum()
    for table in chunks(batches, text_col, CHUNK):
        data, offsets = raw(table.column(text_col).combine_chunks())
        if len(data) <= 2 * CHUNK:
            yield table, *run_buckets(data, offsets, n_buckets, sums), True
            continue
        for i in range(table.num_rows):
            text = data[offsets[i] : offsets[i + 1]]
            for piece, carried, last in _pieces(text) if len(text) else [(text, 0, True)]:
                first, found = run_buckets(piece, np.array([0, len(piece)]), n_buckets, sums)
                yield table.slice(i, 1), first - [0, carried], [b[carried:] for b in found], last


def bucket_counts(docs: DataFrame, text_col: str = "text", n_buckets: int = 10000) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket. Each task sends one row per bucket."""

    def count(batches):
        total = np.zeros(n_buckets, np.int64)
        for _, _, found, _ in _runs(batches, text_col, n_buckets):
            for b in found:
                total += np.bincount(b[b >= 0], minlength=n_buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    found = docs.select(text_col).mapInArrow(count, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, n_buckets: int = 10000) -> np.ndarray:
    """One gain per bucket: how much likelier its features are in the target, in thousandths of the logarithm.

    The array has one entry per bucket whatever the size of the corpus.
    """
    both = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    both = keep(both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")))
    total = both.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("s"), F.coalesce(F.sum("t"), F.lit(0)).alias("t")).first()
    s, t = np.zeros(n_buckets), np.zeros(n_buckets)
    for row in both.collect():
        s[row.bucket], t[row.bucket] = row.s, row.t
    return np.floor(1000 * np.log((t + 1) * (total.s + n_buckets) / ((s + 1) * (total.t + n_buckets)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row: the gains of its features added up (no feature: 0)."""

    def score(batches):
        per_bucket = np.append(gain, 0)  # the last one where no run of that length ends
        words, weight = 0, 0  # of the pieces of a long text so far
        for table, first, found, last in _runs(batches, text_col, len(gain)):
            sums = np.zeros(int(first[-1]) + 1, np.int64)
            np.cumsum(sum(per_bucket[b] for b in found), out=sums[1:])
            words, weight = words + np.diff(first), weight + sums[first[1:]] - sums[first[:-1]]
            if last:
                features = words + np.maximum(words - 1, 0) + np.maximum(words - 2, 0)
                ids = table.column(id_col).combine_chunks().cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(words), pa.array(features), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])
                words, weight = 0, 0

    return docs.select(id_col, text_col).mapInArrow(score, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = 42) -> Column:
    """Gumbel noise of an id in thousandths, from the first 32 bits of a hash (a null id counts as an empty string)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


# ---------------------------------------------------------------- the cut-off key


def _weighted_median(medians: list[tuple[tuple[int, int], int]]) -> tuple[int, int]:
    """The median at which half of the sizes are reached."""
    medians = sorted(medians)
    half, reached = sum(n for _, n in medians) / 2, 0
    for key, n in medians:
        reached += n
        if reached >= half:
            return key
    return medians[-1][0]


def _reports(low: tuple | None, high: tuple | None, pivot: tuple | None):
    """A task's groups of remaining keys: how many lie before, at and after the pivot, and the median of either side."""

    def after(a, b, key):
        return (a > key[0]) | ((a == key[0]) & (b > key[1]))

    def before(a, b, key):
        return (a < key[0]) | ((a == key[0]) & (b < key[1]))

    def report(held):
        a, b = (np.concatenate(x) for x in zip(*held))
        less = before(a, b, pivot) if pivot else np.zeros(len(a), bool)
        more = after(a, b, pivot) if pivot else np.ones(len(a), bool)
        row = [int(less.sum()), len(a) - int(less.sum()) - int(more.sum()), int(more.sum())]
        for side in (less, more):
            x, y = a[side], b[side]
            at = np.lexsort((y, x))[(len(x) - 1) // 2] if len(x) else None
            row += [None, None] if at is None else [int(x[at]), int(y[at])]
        return pa.RecordBatch.from_pylist([dict(zip(_REPORT.names, row))], _REPORT)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("first", "second"))
            left = np.ones(len(a), bool)
            if low:
                left &= after(a, b, low)
            if high:
                left &= before(a, b, high)
            held.append((a[left], b[left]))
            n += int(left.sum())
            if n >= GROUP:
                yield report(held)
                held, n = [], 0
        if n:
            yield report(held)

    return run


_REPORT = pa.schema([(c, pa.int64()) for c in ("less", "same", "more", "less_first", "less_second", "more_first", "more_second")])


def cutoff_key(keys: DataFrame, place: int) -> tuple[int, int] | None:
    """The key at a place (from 1) of the order of (first, second); None where the table has fewer keys.

    Each round is one scan that reports a few numbers for every GROUP of remaining keys; the driver sees these only.
    Half of the keys of groups with half of all remaining keys lie on either side of the weighted median of medians, so a
    quarter of them at least goes with every round; FINISH keys or fewer are sorted at once. `keys` is read once a round:
    pass a table that is written.
    """
    low = high = pivot = None
    while True:
        left = keys
        if low:
            left = left.where((F.col("first") > low[0]) | ((F.col("first") == low[0]) & (F.col("second") > low[1])))
        if high:
            left = left.where((F.col("first") < high[0]) | ((F.col("first") == high[0]) & (F.col("second") < high[1])))
        found = left.mapInArrow(_reports(low, high, pivot), ", ".join(f"{c} long" for c in _REPORT.names)).collect()
        less, same, more = (sum(r[c] for r in found) for c in ("less", "same", "more"))
        if place > less + same + more or place < 1:
            return None
        if less < place <= less + same:
            return pivot
        side, rest = ("less", less) if place <= less else ("more", more)
        if side == "less":
            high = pivot
        else:
            place, low = place - less - same, pivot or low
        if rest <= FINISH:
            if low:
                keys = keys.where((F.col("first") > low[0]) | ((F.col("first") == low[0]) & (F.col("second") > low[1])))
            if high:
                keys = keys.where((F.col("first") < high[0]) | ((F.col("first") == high[0]) & (F.col("second") < high[1])))
            return tuple(sorted(tuple(r) for r in keys.select("first", "second").collect())[place - 1])
        pivot = _weighted_median([((r[f"{side}_first"], r[f"{side}_second"]), r[side]) for r in found if r[side]])


# ---------------------------------------------------------------- the draw


def _ranked(winners: DataFrame) -> DataFrame:
    """`winners` with rank: sorted by ranges, numbered inside each range, moved on by the sizes of the ranges before.

    Rows that are alike in everything are dealt out by a number of their own, so no range holds a crowd of them alone.
    """
    own = winners.columns

    def number(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            places = pa.array(np.arange(at + 1, at + n + 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part)), places], [*batch.schema.names, "part", "place"])
            at += n

    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("row")]
    rows = winners.withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in winners.schema.fields)
    placed = keep(rows.mapInArrow(number, schema + ", part long, place long"))
    # One row per range: as many as the session's shuffle partitions at most.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(sizes), "part").select(*own, (F.col("before") + F.col("place")).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             percent: int = 5, min_words: int = 20, n_buckets: int = 10000, seed: int = 42) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of `docs`; rank is null where a row is not drawn.

    Of the N rows with `min_words` words or more, floor(percent * N / 100) are drawn: those with the highest scores, of
    equal scores the smallest ids first, a null id last. Repeated rows are rows of their own: each counts and is drawn by
    itself (of rows with one score and one id, those with fewer features, then with the lower weight come first). A null
    or empty text has no features and weight 0. With an empty target every gain follows from the corpus alone; an empty
    corpus gives an empty table. Other columns of `docs` are not read, whatever their names.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    gain = gains(bucket_counts(docs, "text", n_buckets), bucket_counts(target, target_text_col, n_buckets), n_buckets)
    scored = keep(weights(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    able = F.col("n_words") >= min_words
    draw = scored.where(able).count() * percent // 100
    keys = scored.where(able).select((-F.col("score")).alias("first"), F.coalesce("doc_id", F.lit(NO_ID)).alias("second"))
    key = cutoff_key(keys, draw)
    none = F.lit(None).cast("long")
    if key is None:
        return scored.withColumn("rank", none)
    first, second = -F.col("score"), F.coalesce("doc_id", F.lit(NO_ID))
    wins = able & ((first < key[0]) | ((first == key[0]) & (second <= key[1])))
    ranked = _ranked(scored.where(wins))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))  # rows alike at the cut-off
    return ranked.unionByName(scored.where(~wins).withColumn("rank", none))
