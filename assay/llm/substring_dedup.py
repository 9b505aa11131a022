"""Removal of repeated passages of words.

Every window of `width` consecutive words gets a Rabin-Karp hash, by prefix sums over the hashes of its words. Windows
are counted in shards of the hash space, thousands packed in one row; of the places of one hash, the earliest (smallest
id, then smallest start) stays and all others go. A chunk of documents sends only the earliest place of a hash, as the
others are decided already, so a passage that is everywhere costs a shard one entry per chunk. The windows that go are
gathered per document and merge into maximal intervals of words.

Words are hashed by mixed 8-byte blocks, which no pattern inside a word cancels; only windows are polynomials, of these
hashes. The shard comes from a second polynomial, so windows are told apart by 64 bits and those of the shard number.
Expected false matches: squared windows / 2 ** (65 + bits of the shard number), below 0.000001 for 10 ** 8 windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    SPANS, Words, byte_slices, chunks, doc_keys, index_keys, keep, keyed, postings, power_of_two, raw, repeated, row_keys, runs,
    span_hashes, span_rows, text_bytes, text_shard, unpack,
)

SLICE, CHUNK, SHARD_WINDOWS = 1 << 20, 4 << 20, 1 << 20
BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
PLACES = "shard long, keys binary, owner binary, pos binary"


def _later(prints: np.ndarray, ids: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """True for each place whose hash also has an earlier one."""
    out = np.zeros(len(prints), bool)
    at = np.flatnonzero(repeated(prints))
    by = at[np.lexsort((pos[at], ids[at], prints[at]))]
    if len(by):
        new = runs(prints[by])
        first = by[np.flatnonzero(new)[np.cumsum(new) - 1]]
        out[by] = (ids[by] != ids[first]) | (pos[by] != pos[first])
    return out


def _windows(width: int, shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows by shard; those that an earlier one of the same chunk decides, by document, in shards below zero."""
    for chunk in chunks(batches, "text", CHUNK):
        keys, base, parts = row_keys(chunk), 0, []
        for part in byte_slices(chunk.to_batches(), "text", SLICE):
            words = Words(*raw(part.column("text")))
            starts, owner = words.windows(width)
            hashes = words.hashes()
            one, two = (span_hashes(hashes, starts, starts + width, b) for b in BASES)
            shard = ((two >> np.uint64(24)).astype(np.int64) % shards).astype(np.int32)
            parts.append((one, shard, (owner + base).astype(np.int32), (starts - words.first[owner]).astype(np.uint32)))
            base += part.num_rows
        prints, shard, owner, pos = (np.concatenate(x) for x in zip(*parts))
        if not len(prints):
            continue
        later = _later(prints, doc_keys(keys)[owner], pos)
        shard = np.where(later, -1 - text_shard(keys, shards)[owner], shard)
        yield from postings(shard, owner, keys, pos=pos, prints=prints).to_batches()


def _judge(shards: int, key: tuple, group: pa.Table) -> pa.Table:
    """The places of a shard that go, by document."""
    keys, owner, values = unpack(group, pos=np.uint32, prints=np.uint64)
    pos = values["pos"]
    at = np.arange(len(pos)) if key[0].as_py() < 0 else np.flatnonzero(_later(values["prints"], doc_keys(keys)[owner], pos))
    owner, pos = owner[at], pos[at]
    return postings(text_shard(keys, shards)[owner], owner, keys, pos=pos) if len(at) else pa.table(
        {c: pa.array([], pa.int64() if c == "shard" else pa.binary()) for c in ("shard", "keys", "owner", "pos")})


def _spans(width: int, group: pa.Table) -> pa.Table:
    keys, owner, values = unpack(group, pos=np.uint32)
    names, index = index_keys(keys)
    starts = values["pos"].astype(np.int64)
    return span_rows(names, index[owner], starts, starts + width)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in byte_slices(batches, "text", SLICE):
        kept, n, removed, spans = [], [], [], []
        columns = (part.column("text").cast(pa.binary()).to_pylist(), part.column("starts").to_pylist(), part.column("ends").to_pylist())
        for text, starts, ends in zip(*columns):
            words = (text or b"").split()
            a, b = (np.frombuffer(x or b"", np.int64).tolist() for x in (starts, ends))
            rest = [w for x, y in zip([0, *b], [*a, len(words)]) for w in words[x:y]] if a else words
            kept.append(b" ".join(rest))
            n.append(len(words))
            removed.append(len(words) - len(rest))
            spans.append([{"first": x, "last": y} for x, y in zip(a, b)])
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(n), pa.array(removed), pa.array(spans, span), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "spans", "kept_text"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, spans (words [first, last) that went), kept_text (words joined by a space).

    A word goes if a window over it also starts earlier: in a row with a smaller id, or in a row of the same id at a
    smaller start. Null ids sort last and count as one id. A null or empty text has no words; a text of fewer words than
    `width` loses none. Rows that are equal in id and text are each returned, with one result. An empty table gives an
    empty result; other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    shards = max(64, power_of_two(text_bytes(docs, text_col) / 6 / SHARD_WINDOWS))
    windows = rows.select("doc_key", "text_key", "text").mapInArrow(
        lambda it: _windows(width, shards, it), PLACES + ", prints binary")
    later = windows.groupBy("shard").applyInArrow(lambda key, group: _judge(shards, key, group), PLACES)
    spans = keep(later.groupBy("shard").applyInArrow(lambda group: _spans(width, group), SPANS))
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<first:long,last:long>>, kept_text string"
    return rows.join(spans, ["doc_key", "text_key"], "left").select("doc_id", "text", "starts", "ends").mapInArrow(_remove, schema)
