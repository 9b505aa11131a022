"""Shared helpers: the shared folder, Arrow batches by bytes, and word boundaries and hashes on raw UTF-8 bytes.

A batch of texts is one byte array with document offsets. Words are runs of bytes outside ASCII white space, so all
bounds and hashes come from a few numpy passes; no Python object is made per word.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of characters other than these six.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a null doc_id in sort orders: last.
NO_ID = 2**63 - 1

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; a temporary one only where Spark runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="assay-llm-"))
    return _own_folder[0]


#: Whether Spark drops the shuffle files of a query when the query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame) -> DataFrame:
    """Write the table to the shared folder and read it back: lineage ends here, and a lost executor costs no rerun.

    The shuffle files behind it are of no use once it is written, so they go then and not when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/assay-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def power_of_two(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(n, 1)))))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_key, text_key, doc_id, text). Rows are told apart by id and text; a null id sorts last, a null text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long").alias("doc_key"),
        F.xxhash64(text).alias("text_key"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
    )


#: A key is hot if more than one in so many rows has it; so there are fewer hot keys than this number.
HOT_KEYS = 4096


def join_hot(rows: DataFrame, table: DataFrame, on: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """Join of rows with a table of one row per key; `size` is the weight of the key's rows, `total` at least their sum.

    Hot keys are fewer than HOT_KEYS whatever the input, so these are broadcast and their rows stay where they are; the
    others are shuffled, where no key brings a task more than one in HOT_KEYS of all rows. `how` is inner or left. Rows
    with a null key have no partner. Both sides are read twice: give them as kept tables, or narrow ones.
    """
    hot, cold = (table.where(c) for c in (F.col(size) * HOT_KEYS > total, F.col(size) * HOT_KEYS <= total))
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on, how)
    return rows.join(F.broadcast(hot), on).unionByName(rest)


def words_of(text: Column) -> Column:
    """Array of the words of a text (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")


# ---------------------------------------------------------------- Arrow batches


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each hold about `limit` bytes (a longer text stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(a, b - a)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts after each other, and the offset of each text (one more than texts). Nulls are empty."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def packed(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def planes(values: np.ndarray) -> bytes:
    """Integers as byte planes: all low bytes, then the next; the near-empty high planes compress to nothing."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


# ---------------------------------------------------------------- words and hashes

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODES = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64)

_BASES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (an odd base is invertible)."""
    have = _BASES.get(base)
    if have is None or len(have[0]) < n:
        size = power_of_two(n)
        both = []
        for b in (base, pow(base, -1, 2**64)):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            both.append(np.cumprod(a, dtype=np.uint64))
        have = _BASES[base] = tuple(both)
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixer for 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial (Rabin-Karp) hash of codes[start:end] for each span, by prefix sums modulo 2**64, mixed at the end."""
    power, inverse = _powers(base, len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * power[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def block_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes data[start:end] of each span: the sum of its 8-byte blocks, each mixed with its place.

    Unlike a polynomial modulo 2**64, this is no linear form of the bytes: a pattern inside a span (a Thue-Morse word and
    its complement, say) cancels nothing.
    """
    sizes = ends - starts
    blocks = np.maximum((sizes + 7) // 8, 1)
    first = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    at, left = np.repeat(starts, blocks) + 8 * place, np.repeat(sizes, blocks) - 8 * place
    padded = np.append(data, np.zeros(8, np.uint8))
    # the block at every byte, read without copying: eight views one byte apart would cost more than gathering
    value = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))[at].copy().view("<u8").ravel()
    value &= (~np.uint64(0)) >> (np.uint64(64) - 8 * np.clip(left, 1, 8).astype(np.uint64))
    value = mix(value ^ mix(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD6E8FEB86659FD93)))
    sums = np.add.reduceat(value, first) if len(value) else value
    return mix(sums + sizes.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


class Words:
    """Word bounds of a batch of texts: byte `starts` and `ends`, and `first`, the index of each text's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data, self.offsets = (_LOWER[data] if lower else data), offsets
        inside = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.ones(len(data), bool)
        before[1:] = ~inside[:-1]
        after = np.ones(len(data), bool)
        after[:-1] = ~inside[1:]
        self.starts = np.flatnonzero(inside & (before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return block_hashes(self.data, self.starts, self.ends)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts (as word indexes) of all windows of `width` words inside one text, and the text of each."""
        owner = self.owners()
        starts = np.arange(len(owner) - width + 1) if len(owner) >= width else np.zeros(0, np.int64)
        starts = starts[owner[starts] == owner[starts + width - 1]] if len(starts) else starts
        return starts, owner[starts]


def runs(values: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before it."""
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


# ---------------------------------------------------------------- packed postings

KEY_BYTES = 16


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """Batches put together, or cut, so that the texts of each table hold about `limit` bytes."""
    rest, have = [], 0
    for part in byte_slices(batches, column, limit):
        rest.append(part)
        have += part.column(column).nbytes
        if have >= limit:
            yield pa.Table.from_batches(rest)
            rest, have = [], 0
    if rest:
        yield pa.Table.from_batches(rest)


def row_keys(table: pa.Table) -> np.ndarray:
    """(doc_key, text_key) of every row as 16 bytes."""
    both = [table.column(c).to_numpy() for c in ("doc_key", "text_key")]
    return np.stack(both, axis=1).astype(np.int64).view(np.uint8).reshape(-1, KEY_BYTES)


def postings(shard: np.ndarray, owner: np.ndarray, keys: np.ndarray, **values: np.ndarray) -> pa.Table:
    """One row per shard: the keys of the owners in it, the number of each value's owner among them, and the values.

    `owner` indexes `keys` and must not decrease. Thousands of values travel as one row of packed arrays.
    """
    order = np.argsort(shard, kind="stable")
    shard, owner = shard[order], owner[order]
    cuts = np.append(np.flatnonzero(runs(shard)), len(shard))
    out: dict[str, list] = {"shard": [], "keys": [], "owner": [], **{k: [] for k in values}}
    for a, b in zip(cuts, cuts[1:]):
        new = runs(owner[a:b])
        out["shard"].append(int(shard[a]))
        out["keys"].append(keys[owner[a:b][new]].tobytes())
        out["owner"].append(planes((np.cumsum(new) - 1).astype(np.uint32)))
        for k, v in values.items():
            part = v[order[a:b]]
            out[k].append(planes(part) if k != "prints" else part.tobytes())
    return pa.table({k: pa.array(v, pa.int64() if k == "shard" else pa.binary()) for k, v in out.items()})


def unpack(group: pa.Table, **types) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """The keys of all rows of a group (16 bytes each), each value's index among them, and the values."""
    keys, owner, base = [], [], 0
    for k, o in zip(group.column("keys").to_pylist(), group.column("owner").to_pylist()):
        keys.append(k)
        owner.append(from_planes(o, np.uint32).astype(np.int64) + base)
        base += len(k) // KEY_BYTES
    values = {
        name: np.concatenate([np.frombuffer(x, t) if name == "prints" else from_planes(x, t) for x in group.column(name).to_pylist()])
        for name, t in types.items()
    }
    return np.frombuffer(b"".join(keys), np.uint8).reshape(-1, KEY_BYTES), np.concatenate(owner), values


def index_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in byte order, and the index of each key among them."""
    halves = np.ascontiguousarray(keys).view(">u8").astype(np.uint64)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = runs(halves[order, 0]) | runs(halves[order, 1])
    index = np.empty(len(keys), np.int64)
    index[order] = np.cumsum(new) - 1
    return keys[order[new]], index


def repeated(values: np.ndarray) -> np.ndarray:
    """True for each value that occurs more than once (values alone sort several times faster than with their places)."""
    ordered = np.sort(values)
    many = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(many):
        return np.zeros(len(values), bool)
    at = np.searchsorted(many, values)
    return many[np.minimum(at, len(many) - 1)] == values


def doc_keys(keys: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(keys[:, :8]).view(np.int64).ravel()


def text_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each row key, by its text and id."""
    halves = np.ascontiguousarray(keys).view(np.uint64).reshape(-1, 2)
    return (mix(halves[:, 0] ^ mix(halves[:, 1])) % np.uint64(shards)).astype(np.int64)


def merge_spans(owner: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal spans of each owner: overlapping and touching ones become one."""
    by = np.lexsort((starts, owner))
    owner, starts, ends = owner[by], starts[by].astype(np.int64), ends[by].astype(np.int64)
    if not len(owner):
        return owner, starts, ends
    # Running largest end inside each owner: owners are moved apart by more than any end.
    apart = int(ends.max()) + 2
    group = np.cumsum(runs(owner)) - 1
    reach = np.maximum.accumulate(ends + group * apart) - group * apart
    first = np.ones(len(owner), bool)
    first[1:] = (group[1:] != group[:-1]) | (starts[1:] > reach[:-1])
    at = np.flatnonzero(first)
    return owner[at], starts[at], reach[np.append(at[1:], len(owner)) - 1]


SPANS = "doc_key long, text_key long, starts binary, ends binary"


def span_rows(keys: np.ndarray, owner: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Table:
    """One row per owner: its key and its merged spans."""
    owner, starts, ends = merge_spans(owner, starts, ends)
    cuts = np.append(np.flatnonzero(runs(owner)), len(owner)) if len(owner) else np.zeros(1, np.int64)
    named = np.ascontiguousarray(keys[owner[cuts[:-1]]]).view(np.int64).reshape(-1, 2)
    return pa.table({
        "doc_key": pa.array(named[:, 0]), "text_key": pa.array(named[:, 1]),
        "starts": pa.array([starts[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        "ends": pa.array([ends[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
    })
