"""Removal of repeated byte strings, by bucket refinement of the suffixes at which they start.

Only suffixes that agree with another one to the depth of `width` bytes matter, so the order inside a bucket is not
needed: a bucket's identifier is a hashed name, and refining sorts the suffixes of a shard by identifiers.

1. Initial buckets. Not every suffix has its own: a window of `width` bytes holds a smallest q-gram, the anchor, at the
   same offset wherever the window occurs, and the windows of one anchor go together. Those that start well before the
   anchor share the q-gram and what is left of it, the others what is right of it; these strings, two thirds of a
   window, name the initial buckets. A bucket with one member has no repeated suffix and is final.
2. A bucket is refined at once where the whole stretch of text under a member's windows has one identifier with another
   member's: all of its suffixes are repeated.
3. The suffixes of the other members are refined by the bucket identifiers of later offsets: depth q with the one q
   further gives depth 2q, and these new identifiers are used again, for each other, to reach the full depth.

Suffixes that are repeated are gathered per document and merge into maximal byte intervals. In each step a chunk of
documents sends one member per identifier, so a string that is everywhere costs a shard one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    _BYTE_CODES, SPANS, byte_slices, chunks, index_keys, keep, keyed, merge_spans, mix, postings, power_of_two, raw, repeated, row_keys,
    runs, span_hashes, span_rows, text_bytes, text_shard, unpack,
)

SLICE, CHUNK, SHARD_BYTES = 1 << 20, 8 << 20, 16 << 20
#: Bytes of the q-gram that anchors a window.
GRAM = 64
BASE = 0x2545F4914F6CDD1D
MEMBERS = "shard long, keys binary, owner binary, pos binary, more binary, prints binary, hulls binary, many binary"
FOUND = "shard long, keys binary, owner binary, pos binary, more binary, open binary"
PLACES = "shard long, keys binary, owner binary, pos binary"


class Grams:
    """Identifiers of all byte strings of a batch of texts, from one prefix sum."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = raw(texts)
        self.codes = _BYTE_CODES[self.data]

    def ids(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return span_hashes(self.codes, starts, ends, BASE)


def anchored(grams: Grams, width: int) -> tuple[np.ndarray, ...]:
    """(first, last, anchor, owner): runs of windows (by start, last included) that have the same anchor."""
    offsets, n = grams.offsets, len(grams.data)
    last = np.repeat(offsets[1:], np.diff(offsets)) - width  # last start of a window in each byte's text
    starts = np.flatnonzero(np.arange(n) <= last)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 4
    at = np.arange(n - GRAM + 1)
    order = grams.ids(at, at + GRAM) & np.uint64(0xFFFFFFFF00000000) | at.astype(np.uint64)
    span, step = width - GRAM + 1, 1  # q-grams in a window
    least = order
    while step * 2 <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if span > step:
        least = np.minimum(least[: len(least) - (span - step)], least[span - step :])
    anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(runs(anchor) | np.append(True, np.diff(starts) > 1))
    final = np.append(first[1:], len(starts)) - 1
    return starts[first], starts[final], anchor[first], np.searchsorted(offsets, starts[first], side="right") - 1


def members(grams: Grams, width: int) -> tuple[np.ndarray, ...]:
    """(owner, first, last, bucket, hull): the windows of each anchor, those far before it and the others apart."""
    first, last, anchor, owner = anchored(grams, width)
    turn = (width - GRAM) // 2  # windows that start more than this before the anchor are on its left
    out = []
    for left in (False, True):
        a = first if left else np.maximum(first, anchor - turn)
        b = np.minimum(last, anchor - turn - 1) if left else last
        at = np.flatnonzero(a <= b)
        a, b, c = a[at], b[at], anchor[at]
        core = (c - turn - 1, c + GRAM) if left else (c, c - turn + width)
        shape = ((c - a) * 1024 + (b - a)).astype(np.uint64)
        out.append((owner[at], a, b, mix(grams.ids(*core) + np.uint64(left)), mix(grams.ids(a, b + width) ^ mix(shape + np.uint64(7)))))
    owner, a, b, bucket, hull = (np.concatenate(x) for x in zip(*out))
    by = np.lexsort((a, owner))
    return owner[by], a[by], b[by], bucket[by], hull[by]


def _classes(bucket: np.ndarray, hull: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (bucket, hull), and in it where a bucket and where a class of equal hulls begins."""
    by = np.lexsort((hull, bucket))
    new_bucket = runs(bucket[by])
    return by, new_bucket, new_bucket | runs(hull[by])


def _members(width: int, shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of the initial buckets by shard: one per class of equal hulls in the chunk. The windows of a class with
    more members are repeated for certain; they go by document, in shards below zero."""
    for chunk in chunks(batches, "text", CHUNK):
        keys, base, parts = row_keys(chunk), 0, []
        for part in byte_slices(chunk.to_batches(), "text", SLICE):
            grams = Grams(part.column("text"))
            owner, a, b, bucket, hull = members(grams, width)
            parts.append((owner + base, (a - grams.offsets[owner]).astype(np.uint32), (b - a).astype(np.uint8), bucket, hull))
            base += part.num_rows
        owner, pos, more, bucket, hull = (np.concatenate(x) for x in zip(*parts))
        if not len(owner):
            continue
        shard = ((bucket >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
        many = repeated(mix(hull) ^ bucket)
        at = np.flatnonzero(many)
        by, _, new = _classes(bucket[at], hull[at])
        send = ~many
        send[at[by[new]]] = True  # one member speaks for its class
        sure = text_shard(keys, shards)[owner[at]]
        at = np.concatenate([np.flatnonzero(send), at])
        shard = np.concatenate([shard[send], -1 - sure])
        fix = np.argsort(owner[at], kind="stable")
        at, shard = at[fix], shard[fix]
        yield from postings(shard, owner[at], keys, pos=pos[at], more=more[at], prints=bucket[at], hulls=hull[at], many=many[at].astype(np.uint8)).to_batches()


def _no_rows(schema: str) -> pa.Table:
    return pa.table({c.split()[0]: pa.array([], pa.int64() if c.endswith("long") else pa.binary()) for c in schema.split(", ")})


def _refine(shards: int, key: tuple, group: pa.Table) -> pa.Table:
    """Members whose windows are repeated (open 0), and those still open (1), by document."""
    keys, owner, values = unpack(group, pos=np.uint32, more=np.uint8, prints=np.uint64, hulls=np.uint64, many=np.uint8)
    pos, more = values["pos"], values["more"]
    if key[0].as_py() < 0:
        at, still = np.arange(len(pos)), np.zeros(len(pos), np.uint8)
    else:
        by, bucket, hull = _classes(values["prints"], values["hulls"])
        size = lambda first: np.diff(np.append(np.flatnonzero(first), len(by)))[np.cumsum(first) - 1]
        many = values["many"][by] > 0
        classes = np.add.reduceat(hull.astype(np.int64), np.flatnonzero(bucket))[np.cumsum(bucket) - 1]
        whole = (size(hull) > 1) | np.maximum.reduceat(many, np.flatnonzero(hull))[np.cumsum(hull) - 1]
        # A class that is settled still speaks, by one member, for its windows in a bucket with other classes.
        speaks = (classes > 1) & (hull | ~whole)
        at = np.concatenate([by[whole], by[speaks]])
        still = np.concatenate([np.zeros(whole.sum(), np.uint8), np.ones(speaks.sum(), np.uint8)])
    if not len(at):
        return _no_rows(FOUND)
    fix = np.argsort(owner[at], kind="stable")
    at, still = at[fix], still[fix]
    return postings(text_shard(keys, shards)[owner[at]], owner[at], keys, pos=pos[at], more=more[at], open=still)


STATE = SPANS + ", open_starts binary, open_ends binary"


def _by_document(width: int, group: pa.Table) -> pa.Table:
    """One row per document: spans that are repeated, and runs of windows still open (last start included)."""
    keys, owner, values = unpack(group, pos=np.uint32, more=np.uint8, open=np.uint8)
    names, index = index_keys(keys)
    owner, start, still = index[owner], values["pos"].astype(np.int64), values["open"] > 0
    last = start + values["more"]
    tables = []
    for side, extra in ((~still, width), (still, 1)):
        tables.append(span_rows(names, owner[side], start[side], last[side] + extra).to_pandas().set_index(["doc_key", "text_key"]))
    both = tables[0].join(tables[1].rename(columns={"starts": "open_starts", "ends": "open_ends"}), how="outer").reset_index()
    return pa.Table.from_pandas(both, preserve_index=False, schema=pa.schema(
        [("doc_key", pa.int64()), ("text_key", pa.int64()), *((c, pa.binary()) for c in ("starts", "ends", "open_starts", "open_ends"))]))


def depths(grams: Grams, starts: np.ndarray, width: int) -> np.ndarray:
    """Bucket identifiers of suffixes at the depth of `width` bytes, by doubling from q-grams.

    A suffix of depth d takes the identifier of the suffix d further (or so much less that it ends at the full depth).
    """
    plan, depth = [], width
    while depth > GRAM:
        half = max(GRAM, -(-depth // 2))
        plan.append((depth, half))
        depth = half
    needed = [np.unique(starts)]  # the suffixes whose identifiers are needed at each depth, from the last back
    for depth, half in plan:
        needed.append(np.unique(np.concatenate([needed[-1], needed[-1] + depth - half])))
    places = needed.pop()
    ids = grams.ids(places, places + GRAM)
    for depth, half in reversed(plan):
        deeper = needed.pop()
        one, two = (ids[np.searchsorted(places, deeper + shift)] for shift in (0, depth - half))
        ids, places = mix(one + mix(two ^ np.uint64(depth))), deeper
    return ids[np.searchsorted(places, starts)]


def _suffixes(width: int, shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes still open, by the shard of their identifier at full depth: one per identifier and chunk."""
    for chunk in chunks(batches, "text", CHUNK):
        keys, base, parts = row_keys(chunk), 0, []
        for part in byte_slices(chunk.to_batches(), "text", SLICE):
            grams = Grams(part.column("text"))
            starts, owner = [], []
            for k, (a, b) in enumerate(zip(part.column("open_starts").to_pylist(), part.column("open_ends").to_pylist())):
                for x, y in zip(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)):
                    starts.append(np.arange(x, y) + grams.offsets[k])
                    owner.append(np.full(y - x, k))
            starts, owner = np.concatenate(starts), np.concatenate(owner)
            parts.append((depths(grams, starts, width), owner + base, (starts - grams.offsets[owner]).astype(np.uint32)))
            base += part.num_rows
        prints, owner, pos = (np.concatenate(x) for x in zip(*parts))
        shard = ((prints >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
        at = np.flatnonzero(repeated(prints))
        by = at[np.argsort(prints[at], kind="stable")]
        send = np.ones(len(prints), bool)
        send[by] = runs(prints[by])
        # All of a repeated identifier are settled; one goes to the shard as well, marked by a second copy of itself.
        place = np.concatenate([np.flatnonzero(send), by[runs(prints[by])] if len(by) else by, by])
        shard = np.concatenate([shard[place[: len(place) - len(by)]], -1 - text_shard(keys, shards)[owner[by]]])
        fix = np.argsort(owner[place], kind="stable")
        yield from postings(shard[fix], owner[place[fix]], keys, pos=pos[place[fix]], prints=prints[place[fix]]).to_batches()


def _settle(shards: int, key: tuple, group: pa.Table) -> pa.Table:
    """Suffixes that are not alone in their bucket, by document."""
    keys, owner, values = unpack(group, pos=np.uint32, prints=np.uint64)
    at = np.arange(len(owner)) if key[0].as_py() < 0 else np.flatnonzero(repeated(values["prints"]))
    if not len(at):
        return _no_rows(PLACES)
    return postings(text_shard(keys, shards)[owner[at]], owner[at], keys, pos=values["pos"][at])


def _spans(width: int, group: pa.Table) -> pa.Table:
    keys, owner, values = unpack(group, pos=np.uint32)
    names, index = index_keys(keys)
    starts = values["pos"].astype(np.int64)
    return span_rows(names, index[owner], starts, starts + width)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in byte_slices(batches, "text", SLICE):
        kept, n, removed, spans = [], [], [], []
        names = ("starts", "ends", "more_starts", "more_ends")
        for text, *bounds in zip(part.column("text").cast(pa.binary()).to_pylist(), *(part.column(c).to_pylist() for c in names)):
            text = text or b""
            a, b, c, d = (np.frombuffer(x or b"", np.int64) for x in bounds)
            a, b = np.concatenate([a, c]), np.concatenate([b, d])
            _, a, b = merge_spans(np.zeros(len(a), np.int64), a, b)
            a, b = a.tolist(), b.tolist()
            rest = b"".join(text[x:y] for x, y in zip([0, *b], [*a, len(text)])) if a else text
            kept.append(rest)
            n.append(len(text))
            removed.append(len(text) - len(rest))
            spans.append([{"first": x, "last": y} for x, y in zip(a, b)])
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(n), pa.array(removed), pa.array(spans, span), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept_bytes"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (bytes [first, last) that went, maximal), kept_bytes.

    A byte goes if a string of `width` bytes over it also starts anywhere else, in any row or at another place of the
    same one; all occurrences go. A null text is empty; shorter texts than `width` lose nothing. Rows that are equal in
    id and text are documents of their own, so they lose all that they share. An empty table gives an empty result;
    other columns are not read. `width` is from 65 to 319.
    """
    if not GRAM < width < GRAM + 256:
        raise ValueError(f"width must be from {GRAM + 1} to {GRAM + 255}")
    rows = keyed(docs, id_col, text_col)
    shards = max(64, power_of_two(text_bytes(docs, text_col) / SHARD_BYTES))
    first = rows.select("doc_key", "text_key", "text").mapInArrow(lambda it: _members(width, shards, it), MEMBERS)
    found = first.groupBy("shard").applyInArrow(lambda key, group: _refine(shards, key, group), FOUND)
    state = keep(found.groupBy("shard").applyInArrow(lambda group: _by_document(width, group), STATE))
    still = state.where("open_starts is not null").select("doc_key", "text_key", "open_starts", "open_ends")
    texts = rows.select("doc_key", "text_key", "text").join(still, ["doc_key", "text_key"])
    suffixes = texts.mapInArrow(lambda it: _suffixes(width, shards, it), PLACES + ", prints binary")
    settled = suffixes.groupBy("shard").applyInArrow(lambda key, group: _settle(shards, key, group), PLACES)
    more = settled.groupBy("shard").applyInArrow(lambda group: _spans(width, group), SPANS)
    more = more.withColumnsRenamed({"starts": "more_starts", "ends": "more_ends"})
    spans = keep(state.select("doc_key", "text_key", "starts", "ends").join(more, ["doc_key", "text_key"], "full"))
    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<first:long,last:long>>, kept_bytes binary"
    joined = rows.join(spans, ["doc_key", "text_key"], "left")
    return joined.select("doc_id", "text", "starts", "ends", "more_starts", "more_ends").mapInArrow(_remove, schema)
