"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram's vector binds its letters by multiplication, each permuted
(rolled) by its place; a text's vector bundles those of its trigrams by addition, and a language's prototype bundles
the texts known to be in it. The language of a text is the one whose prototype has the largest cosine with its vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, raw

DIMENSIONS = 512
SYMBOLS = 128
SLICE = 1 << 20
#: Prototypes travel with the tasks; more languages than this are refused.
MOST_LANGUAGES = 5000


def _symbol_table() -> np.ndarray:
    """Symbol of each code point below 65536: 0 for what isn't a letter; rarer letters share symbols."""
    table = np.zeros(65536, np.uint8)
    for code in range(65536):
        letter = chr(code)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            if 97 <= low <= 122:
                table[code] = low - 96
            elif 0xDF <= low <= 0xFF:
                table[code] = 27 + low - 0xDF
            else:
                table[code] = 60 + low * 40503 % 65521 % (SYMBOLS - 60)
    return table


_tables: dict[str, np.ndarray] = {}


def symbol_table() -> np.ndarray:
    if "symbols" not in _tables:
        _tables["symbols"] = _symbol_table()
    return _tables["symbols"]


def letter_vectors() -> list[np.ndarray]:
    """The letters' vectors for the first, second and third place of a trigram."""
    if "0" not in _tables:
        letters = np.random.default_rng(1729).choice(np.array([-1, 1], np.float32), (SYMBOLS, DIMENSIONS))
        _tables.update({str(k): np.roll(letters, 2 - k, axis=1) for k in range(3)})
    return [_tables[str(k)] for k in range(3)]


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    first, second, third = letter_vectors()
    return first[codes // SYMBOLS**2] * second[codes // SYMBOLS % SYMBOLS] * third[codes % SYMBOLS]


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of each trigram, the text it is in, and for each text whether it has a letter.

    What isn't a letter is one boundary, however long; trigrams do not cross texts and are not centred on a boundary.
    """
    data, offsets = raw(texts)
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    bounds = chars[offsets]
    if len(codes) and codes.max() > 65535:
        symbols = symbol_table()[np.minimum(codes, 0xE000)]  # 0xE000 is no letter
        far = np.flatnonzero(codes > 65535)
        symbols[far] = [60 + c * 40503 % 65521 % (SYMBOLS - 60) if chr(c).isalpha() else 0 for c in codes[far].tolist()]
    else:
        symbols = symbol_table()[codes]
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    # A boundary before each text and after the last, then no two boundaries in a row.
    symbols = np.insert(symbols, bounds, 0)
    owner = np.insert(owner, bounds, np.arange(len(bounds), dtype=np.int32))
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    symbols, owner = symbols[keep].astype(np.int32), owner[keep]
    code = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
    centred = symbols[1:-1] != 0
    has_letter = np.bincount(owner[symbols != 0], minlength=len(bounds))[: len(bounds) - 1] > 0
    return code[centred], owner[1:-1][centred], has_letter


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes and the index of each code among them."""
    seen = np.zeros(SYMBOLS**3, bool)
    seen[codes] = True
    found = np.flatnonzero(seen)
    index = np.empty(SYMBOLS**3, np.int32)
    index[found] = np.arange(len(found), dtype=np.int32)
    return found, index[codes]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, code, n): trigram counts of each slice by language."""
    for part in byte_slices(batches, "text", SLICE):
        code, owner, _ = trigrams(part.column("text"))
        names = part.column("lang").dictionary_encode()
        found, index = _distinct(code)
        if not len(found):
            continue
        lang = names.indices.to_numpy(zero_copy_only=False)[owner].astype(np.int64)
        counts = np.bincount(lang * len(found) + index, minlength=len(names.dictionary) * len(found))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [names.dictionary.take(pa.array(at // len(found))), pa.array(found[at % len(found)].astype(np.int64)), pa.array(counts[at])],
            names=["lang", "code", "n"])


def _prototype(key: tuple, group: pa.Table) -> pa.Table:
    """The bundle of one language; its trigrams are no more than the alphabet allows."""
    codes, counts = group.column("code").to_numpy(), group.column("n").to_numpy()
    order = np.argsort(codes)
    total = np.zeros(DIMENSIONS)
    for at in np.array_split(order, max(1, len(order) // 4096)):
        total += counts[at].astype(np.float64) @ trigram_vectors(codes[at])
    return pa.table({"lang": pa.array([key[0].as_py()]), "vector": pa.array([total.tolist()], pa.list_(pa.float64()))})


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages in order of name and their prototypes, of length 1, from rows whose language is known."""
    known = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    counts = known.mapInArrow(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("lang").applyInArrow(_prototype, "lang string, vector array<double>").limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    rows = sorted((r for r in rows if np.any(r["vector"])), key=lambda r: r["lang"])
    vectors = np.array([r["vector"] for r in rows]).reshape(len(rows), DIMENSIONS)
    return [r["lang"] for r in rows], (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def text_vectors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bundle of each text, and whether it has a letter."""
    code, owner, has_letter = trigrams(texts)
    found, index = _distinct(code)
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for at in range(0, len(found), 4096):  # bounded memory: some distinct trigrams at a time
        part = (index >= at) & (index < at + 4096)
        width = min(4096, len(found) - at)
        counts = np.bincount(owner[part].astype(np.int64) * width + (index[part] - at), minlength=len(texts) * width)
        out += counts.astype(np.float32).reshape(len(texts), width) @ trigram_vectors(found[at : at + width])
    return out, has_letter


def _predict(names: list[str], prototypes: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, "text", SLICE):
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            vectors, has_letter = text_vectors(part.column("text"))
            length = np.linalg.norm(vectors, axis=1)
            known = has_letter & (len(names) > 0)
            if names:
                cosine = vectors @ prototypes.T / np.maximum(length, 1e-9)[:, None]
                best = cosine.argmax(axis=1)
                score = np.where(known, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0)
            else:
                best, score = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows)
            lang = [names[b] if k else "und" for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score.astype(np.float64))],
                names=["doc_id", "lang_pred", "score"])


def identify(docs: DataFrame, names: list[str], prototypes: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (cosine, 0 to 1); one row per row.

    A text that is null or has no letter is `und` with score 0, and so is every text where no language was learned.
    Ties go to the first name. Rows are judged alone: repeated rows and null ids are like others.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda it: _predict(names, prototypes, it), "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, names: list[str], prototypes: np.ndarray) -> DataFrame:
    """The rows of `docs`, with all their columns, whose `text` has a letter; their texts never move.

    Where a language was learned, these are the texts that have one (are not `und`); the cosine never rejects.
    """

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column("text")], names=["doc_id", "text"])
            if names:
                known = [pc.not_equal(p.column("lang_pred"), "und") for p in _predict(names, prototypes, iter([own]))]
            else:
                known = [pa.array(trigrams(p.column("text"))[2]) for p in byte_slices(iter([own]), "text", SLICE)]
            if known:
                yield batch.filter(pa.chunked_array(known).combine_chunks())

    return docs.mapInArrow(chosen, docs.schema)


def fold(id_col: str, folds: int):
    """crc32 of the id as text, modulo `folds`; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(0))


def identify_all(docs: DataFrame) -> DataFrame:
    """Learn from the rows outside the held-out fold (2 of 4), predict all: doc_id, held_out, lang_pred, score."""
    names, prototypes = learn(docs.where(fold("doc_id", 4) != 2))
    return identify(docs, names, prototypes).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
