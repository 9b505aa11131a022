"""Packing of documents into sequences by Karmarkar-Karp multiway differencing.

A document's ids end with a separator. Whole windows are cut from its front and fill sequences by themselves; what is
left, shorter than a window, is halved until no piece exceeds `largest_piece`, so that a window takes several pieces.
These pieces are dealt at random into groups of about `group_pieces`. In a group, the differencing method keeps a heap
of partial partitions and merges the two with the largest imbalance in opposing order (fullest bin onto emptiest) until
one partition into near-equal windows is left. The number of windows starts at the least possible and rises whenever a
window exceeds its capacity.
"""

from __future__ import annotations

import gc
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, keep

WINDOW = 2048
SEPARATOR = 1
#: The tokenizer file is shipped to the tasks as text; a larger one is refused.
MOST_TOKENIZER_BYTES = 64 << 20
#: Words whose ids a task remembers; the memory is emptied when full and at the task's end.
CACHED_WORDS = 1_000_000
#: Bytes of text whose words are cut and numbered at a time.
SLICE = 8 << 20
PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("ids", pa.binary()),
])

_tokenizers: dict[int, tuple] = {}


#: A plain word: letters that normalisation keeps, which the tokenizer never splits before merging, then perhaps closing
#: punctuation, which is a unit of its own. (Characters of the special tokens' strings are left out.)
_CLOSING = rb"[!-/:;=?-`{}~]+"
_PLAIN = re.compile(rb"^(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+(?:%s)?$" % _CLOSING, re.M)
_CLOSES = re.compile(rb"(%s)$" % _CLOSING, re.M)
TOGETHER = 1000
#: The tokenizer finds its special tokens before it lowers case: words with their opening keep their case.
_OPENING = b"<|"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary; spaces and line breaks stay."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(rest) if b not in (10, 32)}


class WordIds(dict):
    """Bytes of a word (see `words_of`) to its ids as little-endian 32-bit integers, filled batch by batch.

    No unit of the tokenizer spans white space and it lowers case, so a text's ids are those of its words in turn. Plain
    words skip the normaliser, which would not change them, and are encoded many at a time; the tokens that end a unit
    tell them apart. Any other word is encoded alone.
    """

    def __init__(self, model: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer, self.plain = Tokenizer.from_str(model), Tokenizer.from_str(model)
        self.plain.normalizer, self.plain.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        self.letters = _byte_letters()
        words = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True

    def _learn_plain(self, words: list[bytes]) -> bool:
        units = _CLOSES.sub(rb" \1", b"\n".join(words))
        text = units.decode().lower().encode().decode("latin-1").translate(self.letters)
        ids = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        gaps = np.frombuffer(units, np.uint8)
        gaps = gaps[(gaps == 10) | (gaps == 32)]
        cut = np.flatnonzero(self.ends[ids]) + 1
        if len(cut) != len(gaps) + 1:  # a tokenizer without such word ends
            return False
        data, cut = ids.tobytes(), (4 * cut[np.append(np.flatnonzero(gaps == 10), -1)]).tolist()
        self.update((w, data[a:b]) for w, a, b in zip(words, [0, *cut], cut))
        return True

    def learn(self, words: set[bytes]) -> None:
        new = words.difference(self)
        if len(self) + len(new) > CACHED_WORDS:
            self.clear()
            new = words
        plain = _PLAIN.findall(b"\n".join(new))
        other = list(new.difference(plain)) if len(plain) < len(new) else []
        for at in range(0, len(plain), TOGETHER):
            if not self._learn_plain(some := plain[at : at + TOGETHER]):
                other += some
        for at in range(0, len(other), TOGETHER):
            some = other[at : at + TOGETHER]
            texts = [w.decode("utf-8", "replace") for w in some]
            coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            self.update((w, np.array(x.ids, "<u4").tobytes()) for w, x in zip(some, coded))


def _word_ids(model: str) -> WordIds:
    key = hash(model)
    if key not in _tokenizers:
        _tokenizers[key] = WordIds(model)
    return _tokenizers[key]


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in ASCII lower case, but for those that may hold a special token."""
    words = text.lower().split()
    if _OPENING in text:
        return [own if _OPENING in own else low for own, low in zip(text.split(), words)]
    return words


def cuts(length: int, window: int, largest_piece: int) -> list[int]:
    """Starts of a document's pieces, and its length: whole windows first, then equal parts of the rest."""
    full = length // window * window
    rest = length - full
    parts = -(-rest // largest_piece)
    return [*range(0, full, window), *(full + rest * i // parts for i in range(parts)), length]


def _coded(texts: pa.Array, ids_of: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts after each other, and the offset of each text (one more than texts).

    Words are cut, told apart and numbered by Arrow, and ids are gathered by number: a Python object is made only for each
    distinct word. Texts that may hold a special token go through `words_of` before.
    """
    texts = texts.cast(pa.large_string())
    low = pc.ascii_lower(texts)
    if len(odd := np.flatnonzero(pc.match_substring(texts, _OPENING.decode()).to_numpy(zero_copy_only=False))):
        own, cut = texts.cast(pa.large_binary()), low.cast(pa.large_binary()).to_pylist()
        for i in odd:
            cut[i] = b" ".join(words_of(own[i].as_py()))
        low = pa.array(cut, pa.large_binary()).cast(pa.large_string(), safe=False)
    words = pc.ascii_split_whitespace(low)
    first, flat = np.asarray(words.offsets), words.values.cast(pa.large_binary()).dictionary_encode()
    known = flat.dictionary.to_pylist()
    ids_of.learn(set(known) - {b""})
    ids_of[b""] = b""  # white space at an end of a text leaves an empty word, of no ids
    found = list(map(ids_of.__getitem__, known))
    ids, sizes = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
    begin = np.cumsum(sizes) - sizes
    which = flat.indices.to_numpy(zero_copy_only=False)
    count = sizes[which]
    ends = np.concatenate([[0], np.cumsum(count)])
    return ids[np.repeat(begin[which] - ends[:-1], count) + np.arange(ends[-1])], ends[first]


def _cut(model: str, window: int, largest_piece: int, with_ids: bool, batches: Iterator[pa.RecordBatch]):
    ids_of = _word_ids(model)
    gc.disable()  # nothing here makes cycles, and the collector would walk all words again and again
    end = np.array([SEPARATOR], "<u4").tobytes()
    for part in byte_slices(batches, "text", SLICE):
        texts = part.column("text").dictionary_encode()  # a text that the mix takes twice is coded once
        ids, offsets = _coded(texts.dictionary, ids_of)
        out: dict[str, list] = {name: [] for name in PIECES.names}
        for doc_id, text in zip(part.column("doc_id").to_pylist(), texts.indices.to_pylist()):
            coded = end if text is None else ids[offsets[text] : offsets[text + 1]].tobytes() + end
            at = cuts(len(coded) // 4, window, largest_piece)
            for a, b in zip(at, at[1:]):
                piece = coded[4 * a : 4 * b]
                out["doc_id"].append(doc_id)
                out["start"].append(a)
                out["length"].append(b - a)
                out["ids_crc32"].append(zlib.crc32(piece))
                out["doc_tokens"].append(at[-1])
                out["ids"].append(piece if with_ids else None)
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in PIECES], schema=PIECES)
    ids_of.clear()
    gc.enable()


def differencing(lengths: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each length, by multiway differencing. Deterministic; `lengths` must be sorted downwards."""
    n = len(lengths)
    if bins <= 1:
        return np.zeros(n, np.int64)
    # A partial partition: sums of its bins (descending) and the tree node of each; bins that are still empty are left out.
    left, right = np.full(2 * n, -1), np.full(2 * n, -1)
    heap = [(-int(x), i) for i, x in enumerate(lengths)]
    heapq.heapify(heap)
    parts = {i: (np.array([x]), np.array([i])) for i, x in enumerate(lengths.astype(np.int64))}
    made, merges = n, n
    while len(heap) > 1:
        a, b = (parts.pop(heapq.heappop(heap)[1]) for _ in range(2))
        sums_b, nodes_b = b[0][::-1], b[1][::-1]
        over = max(0, len(a[0]) + len(sums_b) - bins)
        alone = len(a[0]) - over
        sums = np.concatenate([a[0], sums_b[over:]])
        nodes = np.concatenate([a[1], nodes_b[over:]])
        if over:
            sums[alone : alone + over] += sums_b[:over]
            new = np.arange(made, made + over)
            if made + over > len(left):
                left, right = (np.concatenate([x, np.full(max(n, over), -1)]) for x in (left, right))
            left[new], right[new] = nodes[alone : alone + over], nodes_b[:over]
            nodes[alone : alone + over] = new
            made += over
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        merges += 1
        parts[merges] = (sums, nodes)
        heapq.heappush(heap, (-int(sums[0] - (sums[-1] if len(sums) == bins else 0)), merges))
    out = np.full(made, -1)
    last = next(iter(parts.values()))[1]
    out[last] = np.arange(len(last))
    for node in range(made - 1, n - 1, -1):  # a node's parts come before it
        out[left[node]] = out[right[node]] = out[node]
    return out[:n]


def windows(lengths: np.ndarray, window: int) -> np.ndarray:
    """The window of each piece; the number of windows rises until none exceeds its capacity."""
    count = int(-(-lengths.sum() // window))
    while True:
        bins = differencing(lengths, count)
        sums = np.bincount(bins, lengths, minlength=count)
        over = sums.max() - window
        if over <= 0:
            return bins
        count = min(len(lengths), count + 1 + min(int(over * count / window / 4), count // 256))


def _pack(window: int, key: tuple, group: pa.Table) -> pa.Table:
    order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
    group = group.sort_by(order)
    lengths = group.column("length").to_numpy()
    whole = lengths == window  # first in this order
    n_whole = int(whole.sum())
    bins = np.concatenate([np.arange(n_whole), n_whole + windows(lengths[~whole], window)]) if n_whole < len(lengths) else np.arange(n_whole)
    by = np.argsort(bins, kind="stable")
    total = np.cumsum(lengths[by]) - lengths[by]
    offset = np.empty(len(bins), np.int64)
    offset[by] = total - total[np.searchsorted(bins[by], bins[by])]
    group = group.append_column("sequence_id", pa.array((key[0].as_py() << 32) + bins, pa.int64()))
    return group.append_column("offset", pa.array(offset)).drop_columns(["grp"])


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    group_pieces: int = 512, largest_piece: int = 512, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids where asked for.

    A null or empty text gives the separator alone; a row that occurs twice is packed twice; null ids are kept; an empty
    table gives no rows. Other columns of `docs` are not read. Sequence ids are unique, not dense.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()
    if len(model) > MOST_TOKENIZER_BYTES:
        raise ValueError("the tokenizer file is too large to ship to every task")
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
    pieces = keep(rows.mapInArrow(lambda it: _cut(shipped.value, window, largest_piece, with_ids, it), schema))
    groups = max(1, round(pieces.count() / group_pieces))
    # equal pieces (any number of null or repeated rows) are told apart by their place in the written table
    place = F.monotonically_increasing_id()
    deal = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens", place), F.lit(groups)).cast("long")
    return (
        pieces.withColumn("grp", deal).groupBy("grp")
        .applyInArrow(lambda key, group: _pack(window, key, group), schema + ", sequence_id long, offset long")
    )
