"""Near-duplicate documents: Jaccard join of word n-gram sets by vertical partitioning.

All n-grams have one global order, that of their hashes, and each set is cut into fragments of that order.

Candidates. Two sets of similarity t differ in at most D n-grams, D following from their sizes. Cut into more than D
fragments, linked sets agree wholly in at least one, so every set sends the print of each fragment, and sets that share
a print are candidates. Sizes fall into classes in which one number of fragments serves; a set sends the fragments of
its own class and of the next one, since a partner is at most one class away. Agreement on an empty fragment proves
nothing: a set with so many empty fragments that its agreements could all be empty also sends those of another order
(and after some orders, as happens at low similarities, its single n-grams).

Filter. Candidates form families (components of shared prints). Each set has a parity sketch: one bit per bucket of
n-grams, true where the bucket holds an odd number. Sketches differ in no more bits than the sets differ in n-grams, so
pairs whose sketches differ in more than D bits are no links; families are split to what is left.

Overlaps. Inside a family, the distinct n-grams are cut into fragments again, the overlaps of all pairs are counted per fragment as a product of two 0/1 matrices, and the partial
counts are summed per pair. Families above a bound are cut by size class and hash into blocks and compared block by
block in many tasks. Only a spanning star of the links found leaves a task, never the pairs.

Equal sets are one node from the start. Of the copies in one chunk of rows only the first sends its prints; a text that
is in many chunks is one entry per chunk in each of its shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (
    KEY_BYTES, Words, byte_slices, chunks, index_keys, keep, keyed, mix, postings, power_of_two, raw, runs, span_hashes,
    text_bytes, unpack,
)
from .components import components

SLICE, CHUNK = 2 << 20, 8 << 20
#: N-grams of a family, or of a block of one, that a task compares, a set counting as NODE_GRAMS more; columns of one
#: fragment of the overlap count.
BLOCK_GRAMS, NODE_GRAMS, FRAGMENT = 1 << 18, 256, 2048
#: Orders of the n-grams that are tried before a set sends its n-grams one by one.
ORDERS = 6
#: Prints in one shard, about.
SHARD_PRINTS = 1 << 19


def gram_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text's word n-grams, ascending, and the offsets of the texts (one more than texts).

    A text of fewer words than `width` has its whole sequence as one n-gram; a text without words has none.
    """
    words = Words(*raw(texts), lower=True)
    hashes = words.hashes()
    starts, owner = words.windows(width)
    ends = starts + width
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        at = np.argsort(np.concatenate([owner, short]), kind="stable")
        starts = np.concatenate([starts, words.first[short]])[at]
        ends = np.concatenate([ends, words.first[short + 1]])[at]
        owner = np.concatenate([owner, short])[at]
    grams = span_hashes(hashes, starts, ends, 0xD1342543DE82EF95)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for a, b in zip(bounds, bounds[1:]):
        grams[a:b].sort()
    new = runs(grams) | runs(owner)
    return grams[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def set_keys(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """16 bytes that name each set: two sums of independently mixed hashes."""
    out = np.zeros((len(bounds) - 1, 2), np.uint64)
    for k, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        sums = np.zeros(len(grams) + 1, np.uint64)
        np.cumsum(mix(grams + np.uint64(salt)), out=sums[1:])
        out[:, k] = sums[bounds[1:]] - sums[bounds[:-1]]
    return out.view(np.uint8).reshape(-1, KEY_BYTES)


def levels(similarity: Fraction, sizes: np.ndarray) -> tuple[np.ndarray, float]:
    """Size class of each set, and the width of a class: sets that can be linked are at most one class apart."""
    width = -float(np.log(float(similarity))) * 1.0001
    return np.floor(np.log(np.maximum(sizes, 1)) / width).astype(np.int64), width


def prints(grams: np.ndarray, bounds: np.ndarray, similarity: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(owner, print): prints of the non-empty fragments of each set, ascending by owner."""
    sizes = np.diff(bounds)
    level, width = levels(similarity, sizes)
    share = float(2 * (1 - similarity) / (1 + similarity))
    owners, found = [], []
    for step in (0, 1):
        most = np.floor(share * np.exp((level + step + 1) * width) + 1e-6).astype(np.int64)  # largest difference
        cut = most + 1 + most // 16
        alive = np.flatnonzero((sizes > 0) & (most > 0))  # without a difference, the sets are equal and one node
        order = 0
        while len(alive):
            if order == ORDERS:  # sets of few n-grams for their fragments: links share at least one n-gram
                at = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in alive])
                owners.append(np.repeat(alive, sizes[alive]))
                found.append(mix(grams[at] + np.uint64(0x5851F42D4C957F2D)))
                break
            value = grams if not order else mix(grams + np.uint64(order))
            at = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in alive]) if order else np.flatnonzero(np.repeat((sizes > 0) & (most > 0), sizes))
            owner = np.repeat(alive, sizes[alive])
            value = value[at]
            piece = ((value >> np.uint64(11)).astype(np.float64) * 2.0**-53 * cut[owner]).astype(np.int64)
            if order:  # another order: not ascending any more
                by = np.lexsort((piece, owner))
                value, piece = value[by], piece[by]
            first = np.flatnonzero(runs(owner) | runs(piece))
            sums = np.add.reduceat(mix(value ^ np.uint64(0xA0761D6478BD642F)), first)
            tag = (level[owner[first]] + step).astype(np.uint64) << np.uint64(40) | piece[first].astype(np.uint64) << np.uint64(8)
            owners.append(owner[first])
            found.append(mix(sums + mix(tag + np.uint64(order))))
            empty = cut[alive] - np.bincount(owner[first], minlength=len(sizes))[alive]
            alive = alive[empty >= cut[alive] - most[alive]]
            order += 1
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner, found = np.concatenate(owners), np.concatenate(found)
    by = np.argsort(owner, kind="stable")
    return owner[by], found[by]


def most_apart(similarity: Fraction, sizes: np.ndarray) -> np.ndarray:
    """In how many n-grams two linked sets differ at most, by the sum of their sizes."""
    return (similarity.denominator - similarity.numerator) * sizes // (similarity.denominator + similarity.numerator)


def sketches(grams: np.ndarray, bounds: np.ndarray, similarity: Fraction) -> list[bytes]:
    """Parity sketch of each set; its length, a power of two, is four times the largest difference or more."""
    out = []
    for a, b in zip(bounds, bounds[1:]):
        bits = max(64, power_of_two(4 * most_apart(similarity, 2 * (b - a))))
        odd = np.bincount(((grams[a:b] >> np.uint64(20)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little").tobytes())
    return out


def _sets(width: int, similarity: Fraction, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_key, text_key, doc_id, n, node, sketch): the size, the name and the sketch of each row's set."""
    for part in byte_slices(batches, "text", SLICE):
        grams, bounds = gram_sets(part.column("text"), width)
        names = [k.tobytes() if n else None for k, n in zip(set_keys(grams, bounds), np.diff(bounds))]
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in ("doc_key", "text_key", "doc_id")), pa.array(np.diff(bounds)),
             pa.array(names, pa.binary()), pa.array(sketches(grams, bounds, similarity), pa.binary())],
            names=["doc_key", "text_key", "doc_id", "n", "node", "sketch"])


def _postings(width: int, similarity: Fraction, shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, "text", CHUNK):
        owners, found, keys, base = [], [], [], 0
        for part in byte_slices(chunk.to_batches(), "text", SLICE):
            grams, bounds = gram_sets(part.column("text"), width)
            owner, new = prints(grams, bounds, similarity)
            owners.append(owner + base)
            found.append(new)
            keys.append(set_keys(grams, bounds))
            base += part.num_rows
        owner, found, keys = np.concatenate(owners), np.concatenate(found), np.concatenate(keys)
        once = np.zeros(len(keys), bool)  # equal sets have equal prints
        once[np.unique(index_keys(keys)[1], return_index=True)[1]] = True
        owner, found = owner[once[owner]], found[once[owner]]
        if len(found):
            yield from postings((found >> np.uint64(32)).astype(np.int64) % shards, owner, keys, prints=found).to_batches()


def _candidates(group: pa.Table) -> pa.Table:
    """Stars of the nodes that share a print."""
    keys, owner, values = unpack(group, prints=np.uint64)
    names, index = index_keys(keys)
    node, found = index[owner], values["prints"]
    by = np.lexsort((node, found))
    node, found = node[by], found[by]
    first = runs(found)
    hub = node[np.flatnonzero(first)[np.cumsum(first) - 1]]
    pair = np.unique((node * len(names) + hub)[node != hub])
    ends = [[names[i].tobytes() for i in x] for x in (pair // max(len(names), 1), pair % max(len(names), 1))]
    return pa.table({c: pa.array(x, pa.binary()) for c, x in zip("ab", ends)})


def overlaps(rows: np.ndarray, grams: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Overlap of every set of `left` with every set of `right`; (rows, grams) lists the n-grams of all sets.

    N-grams that only one set has add nothing and go first. The others are cut, in their order, into fragments; the
    partial overlaps of each fragment are a matrix product, and the products are summed.
    """
    by = np.argsort(grams, kind="stable")
    rows, grams = rows[by], grams[by]
    new = runs(grams)
    shared = ~new | np.append(~new[1:], [False] * min(1, len(new)))
    rows = rows[shared]
    column = np.cumsum(new[shared]) - 1 if len(rows) else np.zeros(0, np.int64)
    total = np.zeros((len(left), len(right)), np.float32)
    place = {k: np.full(max(int(x.max()) for x in (left, right)) + 1, -1) for k in "lr"}
    place["l"][left], place["r"][right] = np.arange(len(left)), np.arange(len(right))
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, FRAGMENT):
        a, b = np.searchsorted(column, [at, at + FRAGMENT])
        parts = []
        for side, size in (("l", len(left)), ("r", len(right))):
            matrix = np.zeros((size, FRAGMENT), np.float32)
            r = place[side][rows[a:b]]
            matrix[r[r >= 0], column[a:b][r >= 0] - at] = 1
            parts.append(matrix)
        total += parts[0] @ parts[1].T
    return total


def _spanning(links: np.ndarray) -> np.ndarray:
    """The smallest index linked, over any path, with each index of a symmetric 0/1 matrix."""
    label = np.arange(len(links))
    while True:
        new = np.minimum(label, np.where(links, label[None, :], len(links)).min(axis=1))
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _sets_linked(similarity: Fraction, payload: list[bytes], sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Is each set of `left` linked with each of `right`? Exact."""
    sets = [np.frombuffer(x, np.uint64) for x in payload]
    both = overlaps(np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets), left, right)
    union = (sizes[left][:, None] + sizes[right][None, :]).astype(np.float32) - both
    return similarity.denominator * both >= similarity.numerator * union


def _sketches_near(similarity: Fraction, payload: list[bytes], sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Can each set of `left` be linked with each of `right`, by their sketches? Never false for a link."""
    out = np.zeros((len(left), len(right)), bool)
    length = np.array([len(x) for x in payload])

    def shortened(rows: np.ndarray, size: int) -> np.ndarray:
        """Sketches folded to `size` bytes: halves of a parity sketch add up by exclusive or."""
        folded = []
        for i in rows:
            x = np.frombuffer(payload[i], np.uint64)
            folded.append(np.bitwise_xor.reduce(x.reshape(-1, size // 8), axis=0))
        return np.array(folded).reshape(len(rows), size // 8)

    for one in np.unique(length[left]):
        for two in np.unique(length[right]):
            size = min(one, two)
            a, b = np.flatnonzero(length[left] == one), np.flatnonzero(length[right] == two)
            x, y = shortened(left[a], size), shortened(right[b], size)
            apart = np.zeros((len(a), len(b)), np.int32)
            for word in range(size // 8):
                apart += np.bitwise_count(x[:, word, None] ^ y[None, :, word])
            out[np.ix_(a, b)] = apart <= most_apart(similarity, sizes[left[a]][:, None] + sizes[right[b]][None, :])
    return out


def _compare(similarity: Fraction, linked, group: pa.Table) -> pa.Table:
    """Stars (a, b) of the links inside one task: families, or two blocks of one family (side 0 and side 1)."""
    out: tuple[list, list] = ([], [])
    group = group.sort_by([("family", "ascending"), ("node", "ascending"), ("side", "ascending")])
    family, nodes = group.column("family").combine_chunks(), group.column("node").to_pylist()
    side, n, payload = group.column("side").to_numpy(), group.column("n").to_numpy(), group.column("payload").to_pylist()
    cuts = np.append(np.flatnonzero(runs(family.dictionary_encode().indices.to_numpy())), len(nodes))
    for a, b in zip(cuts, cuts[1:]):
        here = [i for i in range(a, b) if i == a or nodes[i] != nodes[i - 1]]  # a set may come more than once
        left = np.flatnonzero(side[here] == 0)
        right = np.flatnonzero(side[here] == 1) if side[here].max() > 0 else left
        if len(here) < 2 or not len(left) or not len(right):
            continue
        full = np.zeros((len(here), len(here)), bool)
        full[np.ix_(left, right)] = linked(similarity, [payload[i] for i in here], n[here], left, right)
        full |= full.T
        for i, root in enumerate(_spanning(full)):
            if root != i:
                out[0].append(nodes[here[i]])
                out[1].append(nodes[here[root]])
    return pa.table({c: pa.array(x, pa.binary()) for c, x in zip("ab", out)})


def _with_sets(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in byte_slices(batches, "text", SLICE):
        grams, bounds = gram_sets(part.column("text"), width)
        sets = [grams[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in ("family", "node", "level", "n")), pa.array(sets, pa.binary())],
            names=["family", "node", "level", "n", "payload"])


def _tasks(members: DataFrame) -> DataFrame:
    """(task, side, family, node, n, payload): members, with a level, dealt to the tasks that compare them."""
    weight = (F.octet_length("payload") / 8).cast("long") + NODE_GRAMS
    sizes = members.groupBy("family", "level").agg(F.sum(weight).alias("grams_here"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("grams_here") / BLOCK_GRAMS)).cast("long")
    sizes = sizes.withColumn("blocks", blocks).withColumn("whole", F.sum("grams_here").over(Window.partitionBy("family")))
    by_level = Window.partitionBy("family").orderBy("level")
    near = {}
    for name, shift, step in (("below", F.lag, -1), ("above", F.lead, 1)):
        beside = shift("level").over(by_level) == F.col("level") + step
        near[name] = F.coalesce(F.when(beside, shift("blocks").over(by_level)), F.lit(0))
    sizes = keep(sizes.withColumns(near).select(F.col("family").alias("f"), F.col("level").alias("l"), "blocks", "below", "above", "whole"))
    m = members.join(sizes, (F.col("family") == F.col("f")) & (F.col("level") == F.col("l")))
    groups = power_of_two((sizes.where(F.col("whole") <= BLOCK_GRAMS).agg(F.sum(F.col("whole") / F.col("blocks"))).first()[0] or 0) / BLOCK_GRAMS)
    small = m.where(F.col("whole") <= BLOCK_GRAMS).select(
        F.concat(F.lit("g"), F.pmod(F.xxhash64("family"), F.lit(groups)).cast("string")).alias("task"),
        F.lit(0).alias("side"), "family", "node", "n", "payload")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    task = lambda la, a, lb, b: F.concat_ws("-", F.hex("family"), la, a, lb, b)
    level, up, down = F.col("level"), F.col("level") + 1, F.col("level") - 1
    each = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    some = lambda n, f: F.when(F.col(n) > 0, F.transform(each(n), f)).otherwise(F.array().cast("array<struct<task:string,side:int>>"))
    pair = lambda t, s: F.struct(t.alias("task"), s.cast("int").alias("side"))
    inside = some("blocks", lambda j: pair(
        task(level, F.least(F.col("own"), j), level, F.greatest(F.col("own"), j)), F.when(F.col("own") > j, 1).otherwise(0)))
    above = some("above", lambda j: pair(task(level, F.col("own"), up, j), F.lit(0)))
    below = some("below", lambda j: pair(task(down, j, level, F.col("own")), F.lit(1)))
    large = m.where(F.col("whole") > BLOCK_GRAMS).withColumn("own", own)
    large = large.withColumn("t", F.explode(F.concat(inside, above, below))).select("t.task", "t.side", "family", "node", "n", "payload")
    return small.union(large)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: Fraction = Fraction(8, 10)
) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key, first: one row per row.

    component_id is the smallest id that is reachable over links, its own included; null ids come last. `first` is true
    for the row of each component that stays: the one with the smallest id, then text_key (a hash of the text); rows
    that share both are the same document and get the same results. A text without words, or null, is linked with
    nothing. N-grams are told apart by 64-bit hashes, sets by 128 bits. An empty table gives an empty result.
    """
    rows = keyed(docs, id_col, text_col)
    shards = power_of_two(text_bytes(docs, text_col) / 6 * 2.2 * float(1 - similarity) / SHARD_PRINTS)
    shards = max(64, shards)
    table = keep(rows.mapInArrow(lambda it: _sets(width, similarity, it), "doc_key long, text_key long, doc_id long, n long, node binary, sketch binary"))
    packed = rows.select("text").mapInArrow(
        lambda it: _postings(width, similarity, shards, it), "shard long, keys binary, owner binary, prints binary")
    stars = packed.groupBy("shard").applyInArrow(_candidates, "a binary, b binary")
    nodes = table.where("node is not null").groupBy("node").agg(
        F.min(F.struct("doc_key", "text_key")).alias("best"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    size_class = F.floor(F.log(F.col("n").cast("double")) / levels(similarity, np.ones(1))[1]).cast("long")
    named = nodes.select("node", "n", size_class.alias("level"), "best.doc_key", "best.text_key", F.col("sketch").alias("payload"))

    def links(members: DataFrame, linked) -> DataFrame:
        return _tasks(members).groupBy("task").applyInArrow(lambda g: _compare(similarity, linked, g), "a binary, b binary")

    families = components(stars).withColumnRenamed("root", "family")
    near = components(links(keep(families.join(named, "node")), _sketches_near)).withColumnRenamed("root", "family")
    wanted = near.join(named.drop("payload"), "node")
    members = rows.select("doc_key", "text_key", "text").join(wanted, ["doc_key", "text_key"]).select("family", "node", "level", "n", "text")
    members = keep(members.mapInArrow(lambda it: _with_sets(width, it), "family binary, node binary, level long, n long, payload binary"))
    roots = keep(components(links(members, _sets_linked)))
    named = nodes.join(roots, "node", "left").select("node", "best", F.coalesce("root", "node").alias("root"))
    best = named.groupBy("root").agg(F.min("best").alias("least"))
    final = named.join(best, "root").select("node", "least")
    own = F.struct("doc_key", "text_key")
    least = F.coalesce("least", own)
    return table.join(final, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("least").isNull(), F.col("doc_id")).otherwise(F.nullif(F.col("least.doc_key"), F.lit(2**63 - 1))).alias("component_id"),
        "text_key", (own == least).alias("first"))
