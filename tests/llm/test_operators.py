"""Every operator against a brute-force version on a small table with nulls, ties, repeats, long texts and odd columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assay.llm import (
    exact_dedup, language, license_scan, mixing, ngram_join, packing, quality_model, quality_rules, substring_dedup,
    suffix_dedup,
)
from assay.llm.common import join_hot, unpack
from assay.llm.components import components
from assay.llm.license_rules import STEMS, rules
from assay.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, size long, print string, pos int, task string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts() -> list[tuple]:
    """(doc_id, text, lang, source) with the cases that operators must define."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage = prose(60)
    base = prose(150)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base.replace(" ", "\n"), "en", "b"), (4, base.upper(), None, "b"),
        (5, None, "en", "a"), (6, "", None, None), (7, " \t\n ", "en", ""), (8, "Ünï ßtraße — 漢字 é́ 🙂", "xx", "c"),
        (9, "one", "en", "a"), (10, "one two", "en", "a"), (11, "one two", None, "a"),
        (12, prose(40) + "\n" + passage + "\n" + prose(40), "en", "a"), (13, passage + " " + prose(30), "en", "a"),
        (14, prose(20) + " " + passage, "de", "c"), (15, "ha " * 300, "de", "c"), (16, "line of text\n" * 40, "de", "c"),
        (17, prose(9000), "en", "a"), (18, "x" * 30_000, None, "a"), (19, "é" * 700, None, "a"),
        (None, base + " end", None, None), (None, prose(25), "en", None), (20, "same id " * 12, "en", "b"), (20, prose(30), "en", "b"),
        (21, prose(50), "en", "b"), (21, prose(50), "en", "b"), (-4, passage, "en", "z"),
    ]
    twice = prose(70)
    rows += [(22, twice, "en", "b"), (22, twice, "en", "b")]  # one row that the table has twice
    for k in range(30):  # near copies of one text, some linked only over others
        words = base.split()
        for _ in range(k % 4):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        rows.append((100 + k, " ".join(words), "en", "a"))
    rows += [(200 + k, prose(r.randint(1, 80)), r.choice(["en", "de", None]), r.choice(["a", "b", "c"])) for k in range(40)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d")
    spark.createDataFrame([(*x, None, 7, "p", None, "t") for x in rows], SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def key(doc_id):
    return (doc_id is None, doc_id or 0)


def found(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def sha(text: bytes | str) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_dedup(docs, rows, bits):
    """With 3-bit fingerprints nearly all texts collide, and the byte verification has to tell them apart."""
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    want = Counter()
    for text, ids in groups.items():
        first = min(ids, key=key)
        want.update((i, first, len(ids), sha(text), len(text.encode())) for i in ids)
    out = exact_dedup.exact_groups(docs, print_bits=bits)
    assert found(out, "doc_id", "keep_id", "group_size", "text_sha256", "text_size") == want
    kept = [r for r in out.collect() if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_filters_merge_without_loss(spark):
    """Counts of merged partition filters equal counts of the fingerprints."""
    prints = [hash(str(i % 700)) * 977 % 2**64 - 2**63 for i in range(2000)] + [5] * 50
    df = spark.createDataFrame([(p,) for p in prints], "print long").repartition(7)
    got = {r["print"]: r["copies"] for r in exact_dedup.repeated_fingerprints(df, len(prints)).collect()}
    assert got == {p: n for p, n in Counter(prints).items() if n > 1}


@pytest.mark.parametrize("block", [16, 1024])
def test_mixing(docs, rows, block):
    places, pieces = mixing.mix(docs, block_words=block)
    out = mixing.mix_report(places, pieces).collect()
    size = lambda t: len(WORD.findall(t or ""))
    totals = defaultdict(int)
    for _, text, _, source in rows:
        totals[source] += size(text)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(totals, key=lambda s: (s is None, s or "")))}
    target, fixed = {}, set()
    while True:  # share by weight, fix what exceeds its limit, share the rest again
        free = [s for s in totals if s not in fixed]
        left = 1.5 * sum(totals.values()) - sum(2 * totals[s] for s in fixed)
        target = {s: 2.0 * totals[s] if s in fixed else left * weight[s] / sum(weight[x] for x in free) for s in totals}
        above = {s for s in free if target[s] > 2 * totals[s]}
        if not above:
            break
        fixed |= above
    source_of = Counter((i, size(t), totals[s]) for i, t, _, s in rows)
    assert Counter((r["doc_id"], r["size"], r["source_size"]) for r in out) == source_of
    assert all(r["taken"] <= 2 * r["size"] for r in out)
    taken, targets = defaultdict(int), {}
    for r in places.join(pieces, ["source", "position"], "left").select(places["source"], "target").distinct().collect():
        targets[r["source"]] = r["target"]
    for r in pieces.collect():
        taken[r["source"]] += r["last_word"] - r["first_word"]
    for s in totals:
        assert targets.get(s, target[s]) == pytest.approx(target[s])
        assert taken[s] == int(min(target[s], 2 * totals[s]) + 1e-9)
    again = mixing.mix_report(*mixing.mix(docs.repartition(3), block_words=block)).collect()
    assert Counter(again) == Counter(out)


def test_schedule_is_spread_evenly(spark):
    """Every prefix of the schedule holds the sources in nearly their shares."""
    sources = spark.createDataFrame([("a", 5000, 6000.0), ("b", 9000, 3000.0), (None, 1000, 2000.0)], "source string, source_size long, target double")
    slots = sorted((r["slot"], r["source"]) for r in mixing.schedule(sources, 10).collect())
    counts = Counter()
    for n, (_, source) in enumerate(slots, 1):
        counts[source] += 1
        for s, share in (("a", 6 / 11), ("b", 3 / 11), (None, 2 / 11)):
            assert abs(counts[s] - n * share) < 12
    assert counts == {"a": 600, "b": 300, None: 200}


def test_mixed_documents(docs):
    places, pieces = mixing.mix(docs)
    out = mixing.mixed_documents(docs, places, pieces)
    assert out.columns == docs.columns
    words = out.agg(F.sum(mixing.n_words(F.col("text")))).first()[0]
    assert words == pieces.agg(F.sum(F.col("last_word") - F.col("first_word"))).first()[0]


def test_substring_dedup(docs, rows):
    places = defaultdict(list)
    for n, (doc_id, text, *_) in enumerate(rows):
        words = WORD.findall(text or "")
        for i in range(len(words) - 19):
            places[tuple(words[i : i + 20])].append((key(doc_id), i, n))
    gone = defaultdict(set)
    for where in places.values():
        first = min(where)[:2]
        for doc_id, i, n in where:
            if (doc_id, i) != first:
                gone[n].update(range(i, i + 20))
    want = Counter()
    for n, (doc_id, text, *_) in enumerate(rows):
        words = WORD.findall(text or "")
        want[doc_id, len(words), len(gone[n]), " ".join(w for j, w in enumerate(words) if j not in gone[n])] += 1
    assert found(substring_dedup.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_text") == want


@pytest.mark.parametrize("width", [200, 90])
def test_suffix_dedup(docs, rows, width):
    data = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    want = Counter()
    for (doc_id, *_), d in zip(rows, data):
        gone = np.zeros(len(d) + 1, int)
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                gone[i] += 1
                gone[i + width] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(d) else 0
        want[doc_id, len(d), int(gone.sum()), spans, bytes(np.frombuffer(d, np.uint8)[~gone])] += 1
    out = suffix_dedup.remove_repeats(docs, width=width).withColumn("n_spans", F.size("spans"))
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept_bytes"])) for r in out.collect())
    assert got == want


def brute_components(rows, width, similarity):
    sets = []
    for _, text, *_ in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and similarity.denominator * both >= similarity.numerator * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), (True, 0)), key(rows[i][0]))
    return Counter((r[0], len(s), None if least[find(i)][0] else least[find(i)][1]) for i, (r, s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("width, similarity, grams", [(3, Fraction(9, 10), 1 << 18), (5, Fraction(8, 10), 1 << 18), (3, Fraction(1, 2), 1500)])
def test_ngram_join(docs, rows, width, similarity, grams, monkeypatch):
    """The last case cuts families into many small blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", grams)
    out = ngram_join.near_duplicates(docs, width=width, similarity=similarity)
    assert found(out, "doc_id", "n_shingles", "component_id") == brute_components(rows, width, similarity)


def test_prints_find_every_link():
    """Random sets at the edge of the threshold: linked sets share a print, and sketches never rule a link out."""
    r = np.random.default_rng(3)
    for n in (3, 8, 9, 10, 11, 19, 20, 40, 150, 999):
        for _ in range(20):
            similarity = Fraction(9, 10)
            one = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
            swap = int(r.integers(0, max(1, n // 10) + 1))
            two = np.unique(np.concatenate([one[swap:], r.integers(0, 2**63, int(r.integers(0, max(1, n // 15) + 1)), dtype=np.uint64)]))
            both = len(np.intersect1d(one, two))
            if 10 * both < 9 * (len(one) + len(two) - both) or np.array_equal(one, two):
                continue
            grams, bounds = np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)])
            owner, prints = ngram_join.prints(grams, bounds, similarity)
            assert set(prints[owner == 0]) & set(prints[owner == 1])
            sketch = ngram_join.sketches(grams, bounds, similarity)
            assert ngram_join._sketches_near(similarity, sketch, np.diff(bounds), np.array([0]), np.array([1]))[0, 0]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}


def test_components_with_hubs(spark):
    """A star of 9,000 nodes, a chain and many pairs: the hub is hot, the pairs are not."""
    hub = 20_000
    edges = [(hub, i) for i in range(9_000)] + [(30_000 + i, 30_001 + i) for i in range(9)]
    edges += [(40_000 + 2 * i, 40_001 + 2 * i) for i in range(9_000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {hub: 0} | {i: 0 for i in range(9_000)} | {30_000 + i: 30_000 for i in range(10)}
    assert got == want | {40_000 + i: 40_000 + i - i % 2 for i in range(18_000)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_join_as_others(spark, how):
    keys = [None] * 50 + [7] * 3000 + list(range(100, 5100))
    rows = spark.createDataFrame(list(enumerate(keys)), "i long, k long")
    table = rows.where("k is not null and k <> 105").groupBy("k").agg(F.count("*").alias("size"))
    joined = join_hot(rows, table, ["k"], "size", len(keys), how)
    want = rows.join(table, "k", how)
    assert joined.columns == want.columns and found(joined, *want.columns) == found(want, *want.columns)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2


def test_copies_in_a_chunk_send_their_prints_once():
    one, two = " ".join(f"w{i}" for i in range(80)), " ".join(f"w{i}" for i in range(1, 81))

    def sent(texts):
        batches = [pa.record_batch({"text": pa.array(texts[i : i + 7])}) for i in range(0, len(texts), 7)]
        groups = list(ngram_join._postings(5, Fraction(8, 10), 4, iter(batches)))
        out = Counter()
        for g in groups:
            keys, owner, values = unpack(pa.Table.from_batches([g]), prints=np.uint64)
            out.update((keys[o].tobytes(), int(p)) for o, p in zip(owner, values["prints"]))
        return out

    want = sent([one, two, "", None])
    assert len({k for k, _ in want}) == 2 and set(want.values()) == {1}
    assert sent([one, None, *[two, one.upper(), one] * 20, ""]) == want


def test_equal_pieces_are_dealt_over_all_groups(spark):
    docs = spark.range(4000).selectExpr("cast(null as long) as doc_id", "cast(null as string) as text")
    groups = packing.pack(docs, tokenizer_path(), group_pieces=100).selectExpr("sequence_id >> 32 as grp", "length").groupBy("grp").count().collect()
    assert sum(g["count"] for g in groups) == 4000
    assert len(groups) == 40 and max(g["count"] for g in groups) < 200


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    out = packing.pack(docs, tokenizer_path(), with_ids=True).collect()
    want = Counter()
    for doc_id, text, *_ in rows:
        want[doc_id, tuple([*coder.encode(text or "", add_special_tokens=False).ids, 1])] += 1
    parts = defaultdict(list)
    for r in out:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        parts[r["doc_id"], r["doc_tokens"], r["start"]].append(tuple(ids.tolist()))
    for (doc_id, ids), n in want.items():  # every id in exactly one piece
        covered = 0
        while covered < len(ids):
            pieces = [p for p in parts[doc_id, len(ids), covered] if p == ids[covered : covered + len(p)]]
            assert len(pieces) >= n
            covered += len(pieces[0])
    assert sum(r["length"] for r in out) == sum(len(ids) * n for (_, ids), n in want.items())
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_differencing_is_near_equal():
    lengths = np.sort(np.random.default_rng(0).integers(1, 513, 700))[::-1]
    sums = np.bincount(packing.windows(lengths, 2048), lengths)
    assert sums.max() <= 2048 and sums.sum() == lengths.sum()
    assert len(sums) * 2048 < 1.04 * lengths.sum()
    assert packing.windows(np.array([2000] * 5), 2048).max() == 4  # the number of windows rises


def test_word_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    with open(tokenizer_path()) as f:
        ids = packing.WordIds(f.read())
    coder = Tokenizer.from_file(tokenizer_path())
    text = "don't. DON'T stop, 'tis é, É. ÀÖ× ÷ İstanbul, é. 12.5 a1b2 x... hello!,. l'été it's., b.\x85c.\x1cd ß. ﬁ. …, a…. 漢字, <|endoftext|> x<|endoftext|>. Ǆ, K. \xa0z."
    words = text.encode().lower().split()
    ids.learn(set(words))
    assert np.frombuffer(b"".join(ids[w] for w in words), "<u4").tolist() == coder.encode(text, add_special_tokens=False).ids


def test_special_tokens_keep_their_case(spark):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    texts = [
        "an <|ENDOFTEXT|> or <|StartOfText|>", "A<|EndOfText|>B <|endoftext|> X<|startoftext|>Y", "ONE <|TWO <|endoftext|>. É<|X",
        "<|end OfText|> PLAIN Words <|\n|>"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: coder.encode(x, add_special_tokens=False).ids + [1] for i, x in enumerate(texts)}
    out = packing.pack(table, tokenizer_path(), with_ids=True).collect()
    assert {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in out} == want
    assert {r["doc_id"]: r["ids_crc32"] for r in out} == {i: zlib.crc32(np.array(x, "<u4").tobytes()) for i, x in want.items()}
    assert 49407 not in want[0] and want[1].count(49407) == 1


def brute_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    repeat = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    chars, n = sum(map(len, words)), len(words)
    symbols, dup = len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(repeat) > 50 * n
    rejected = (
        5 * symbols > n or 10 * len(re.findall("[A-Z]", text)) > 3 * chars or 10 * len(re.findall("[0-9]", text)) > 3 * chars
        or 2 * text.count("!") > n or chars < 2 * n or chars > 12 * n or 10 * dup > 4 * len(lines) or 10 * len(set(words)) < n)
    return n, chars, symbols, dup, len(repeat), failed, not (failed or rejected)


def test_quality_rules(docs, rows):
    want = Counter((r[0], *brute_rules(r[1])) for r in rows)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert found(quality_rules.judge(docs), *columns) == want
    order = quality_rules.order_rules(docs)
    assert {r.name for r in order} == {r.name for r in quality_rules.RULES}
    assert found(quality_rules.judge(docs, rules=quality_rules.RULES[::-1]), *columns) == want


def test_language(spark, docs, rows, nothing):
    out = language.identify_all(docs.select("doc_id", "text", "lang")).collect()
    assert len(out) == len(rows)
    for r, text in zip(sorted(out, key=lambda r: key(r["doc_id"])), [t for _, t, *_ in sorted(rows, key=lambda x: key(x[0]))]):
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {"en", "de", "xx", "und"}
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[5]["lang_pred"] == by_id[6]["lang_pred"] == by_id[7]["lang_pred"] == "und"
    assert by_id[8]["lang_pred"] != "und"
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    names, prototypes = language.learn(nothing)
    assert names == [] and {r["lang_pred"] for r in language.identify(docs, names, prototypes).collect()} == {"und"}


def test_language_is_cosine_of_bundles(spark):
    """Text vectors equal the sum of bound trigram vectors, letter by letter."""
    import pyarrow as pa

    first, second, third = language.letter_vectors()
    symbols = [0, *(language.symbol_table()[ord(c)] for c in "abé"), 0]
    want = sum(first[a] * second[b] * third[c] for a, b, c in zip(symbols, symbols[1:], symbols[2:]))
    vectors, letters = language.text_vectors(pa.array(["  AbÉ--", "12", None, "zz"]))
    assert np.array_equal(vectors[0], want) and letters.tolist() == [True, False, False, True]


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify_all(docs).where("held_out").join(docs, "doc_id")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def test_quality_model_held_out(spark, docs, rows, nothing):
    path = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    out = quality_model.classify(spark.read.parquet(f"{path}/documents.parquet"), labels).where("held_out").join(labels, "doc_id")
    right = out.groupBy("quality").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int")).alias("r")).collect()
    assert all(r["r"] > 0.95 for r in right) and len(right) == 2
    few = spark.createDataFrame([(1, 1), (9, 0), (None, 1), (2, None)], "doc_id long, quality int")
    for table in (few, few.limit(0)):
        scored = quality_model.classify(docs, table).collect()
        assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)


def test_license_base(docs, rows):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    extra = ["MIT License, mit license mit  LICENSE", "the Apache\nlicense; GNU general public license v3", "permit license", "mit licenses", "Apache-License"]
    spark = docs.sparkSession
    table = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(extra, 900)), "doc_id long, text string"))
    want = Counter()
    for doc_id, text in [*((r[0], r[1]) for r in rows), *enumerate(extra, 900)]:
        words = pattern.findall((text or "").translate(lower))
        places = [(i, label) for phrase, label in license_scan.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        at = [i for i, _ in places]
        want[doc_id, len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))] += 1
    out = license_scan.scan(table)
    assert found(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in out.collect())


def test_license_suppression(spark):
    texts = {
        1: "Licensed under the Apache License, Version 2.0 (the terms)", 2: "Released under the MIT License.",
        3: "GNU Lesser General Public License version 2.1 here", 4: "Licensed under CC BY-NC-SA 4.0.", 5: "All rights reserved.",
        6: "nothing to see", 7: "SPDX-License-Identifier: BSD-3-Clause",
    }
    out = {r["doc_id"]: r for r in license_scan.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    labels = {i: r["labels"] for i, r in out.items()}
    assert labels == {1: "apache,apache-2.0", 2: "mit", 3: "gpl,lgpl-2.1", 4: "cc-by-nc-sa-4.0", 5: "all-rights-reserved", 6: "", 7: "bsd-3-clause"}
    assert out[1]["score"] == 1 and out[6]["score"] == 0 and len(out[1]["detections"]) == 1


def test_license_rules_need_a_stem():
    assert len(rules()) > 200
    for label, _, keyword, pattern in rules():
        plain = re.sub(r"\\S|\\d", "", pattern)
        assert any(s in plain for s in STEMS) or label.startswith("cc-by"), (label, pattern)
        re.compile(pattern)


def examples(pattern: str) -> list[str]:
    """Texts that match a rule's pattern: the shortest one, and others that differ from it in one choice each."""
    def of(items) -> list[str]:
        parts = [each(*item) for item in items]
        first = [p[0] for p in parts]
        return ["".join(first), *("".join([*first[:i], x, *first[i + 1 :]]) for i, p in enumerate(parts) for x in p[1:])]

    def each(kind, value) -> list[str]:
        kind = str(kind)
        if kind == "LITERAL":
            return [chr(value)]
        if kind == "IN":
            kinds = [(str(k), v) for k, v in value]
            return [chr(v) for k, v in kinds if k == "LITERAL"] or ["7" if str(kinds[0][1]) == "CATEGORY_DIGIT" else "w"]
        if kind == "BRANCH":
            return [x for b in value[1] for x in of(b)]
        if kind == "SUBPATTERN":
            return of(value[3])
        low, high, inner = value
        assert kind == "MAX_REPEAT", kind
        some = of(inner)
        return [some[0] * low, *(x * max(1, low) for x in some)] if high > low else [x * low for x in some]

    return list(dict.fromkeys(of(re._parser.parse(pattern))))


def test_license_gates_lose_no_match(spark):
    """Scans with and without the gate and the keywords give equal detections on examples of every rule."""
    texts = [x for *_, pattern in rules() for x in examples(pattern)]
    assert all(any(re.fullmatch(p, x) for x in texts) for *_, p in rules())
    texts = list(dict.fromkeys(texts))
    texts += ["Photo by A. Smith, CC BY 4.0", "Figure 2 (CC BY-NC-SA 3.0)", "see cc--by\t2.5!", "Released under the WTFPL", "acc by 4 0"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in license_scan.scan(table.repartition(16)).collect()}
    tried = [(n, label, rank, re.compile(f"(?<![^ ])(?:{p})(?![^ ])")) for n, (label, rank, _, p) in enumerate(rules())]
    for i, text in enumerate(texts):
        line = re.sub(license_scan.BREAKS, " ", text.lower()).strip()
        found = [(line.count(" ", 0, m.start()), line.count(" ", 0, m.end()), rank, n, label) for n, label, rank, p in tried for m in p.finditer(line)]
        stronger = lambda e, d: (e[2], e[1] - e[0], -e[3]) > (d[2], d[1] - d[0], -d[3])
        want = Counter(d[4:] + d[2:3] + d[:2] for d in found if not any(e[0] <= d[0] and e[1] >= d[1] and stronger(e, d) for e in found))
        assert Counter((d["label"], d["rank"], d["first"], d["last"]) for d in out[i]["detections"]) == want, text
    assert [out[i]["labels"] for i in range(len(texts) - 5, len(texts))] == ["cc-by-4.0", "cc-by-nc-sa-3.0", "cc-by-2.5", "wtfpl", ""]


@pytest.mark.parametrize("run", [
    lambda d: exact_dedup.exact_groups(d), lambda d: mixing.mix_report(*mixing.mix(d)), lambda d: substring_dedup.remove_repeats(d),
    lambda d: suffix_dedup.remove_repeats(d), lambda d: ngram_join.near_duplicates(d), lambda d: packing.pack(d, tokenizer_path()),
    lambda d: quality_rules.judge(d), lambda d: license_scan.scan(d), lambda d: language.identify_all(d),
    lambda d: quality_model.classify(d, d.select("doc_id", F.lit(1).alias("quality"))),
])
def test_empty_table(nothing, run):
    assert run(nothing).collect() == []


def test_structured_words_are_told_apart(spark):
    """A Thue-Morse word and its complement, alone and before one common passage: a polynomial modulo 2**64 confuses them."""
    signs = [bin(i).count("1") & 1 for i in range(2048)]
    one, two = ("".join(letters[s] for s in signs) for letters in ("ab", "ba"))
    tail = " ".join(f"w{i}" for i in range(19))
    passages = spark.createDataFrame([(1, f"{one} {tail}"), (2, f"{two} {tail}")], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup.remove_repeats(passages).collect()] == [0, 0]
    alone = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    found = ngram_join.near_duplicates(alone, width=3, similarity=Fraction(90, 100))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(1, 1), (2, 2)]
    lines = spark.createDataFrame([(1, f"{one}\n{two}\n{one}")], "doc_id long, text string")
    assert quality_rules.judge(lines).first().n_dup_lines == 1


def test_words_of_a_slice_are_coded_by_number():
    """Words cut by Arrow have the ids that the tokenizer gives each text; texts alike and words alike are coded once."""
    with open(tokenizer_path(), encoding="utf-8") as f:
        ids_of = packing.WordIds(f.read())
    texts = [" Two  words,\\tTwo WORDS\\n", "", " \\r\\n ", "a\\x0bb\\x0cc a\\x1cb \\u00a0nbsp", "<|endoftext|> End <|ENDOFTEXT|>x", "Straße ÄÖ 漢字 don't (x)", None, "Two words"]
    seen = []
    learn = ids_of.learn
    ids_of.learn = lambda words: (seen.append(words), learn(words))
    got = packing._coded(pa.array(texts).dictionary_encode().dictionary, ids_of)
    ids, offsets = got
    known = [t for t in texts if t is not None]
    assert len(offsets) == len(known) + 1 and offsets[-1] == len(ids)
    for i, text in enumerate(known):
        words = packing.words_of(text.encode())
        assert [x for w in words for x in ids_of.tokenizer.encode(w.decode(), add_special_tokens=False).ids] == ids[offsets[i] : offsets[i + 1]].tolist()
    assert len(seen) == 1 and b"" not in seen[0] and b"words" in seen[0] and b"<|ENDOFTEXT|>x" in seen[0] and b"WORDS" not in seen[0]
    for some in (pa.array([], pa.string()), pa.array([""], pa.string())):
        ids, offsets = packing._coded(some, ids_of)
        assert len(ids) == 0 and len(offsets) == len(some) + 1
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([None, "a b", "a b"], pa.string())], ["doc_id", "text"])
    rows = pa.Table.from_batches(packing._cut(ids_of.tokenizer.to_str(), 2048, 512, True, iter([batch.slice(0, 1), batch]))).to_pylist()
    assert [r["doc_id"] for r in rows] == [1, 1, 2, 3] and rows[2]["ids"] == rows[3]["ids"] and rows[0]["length"] == 1 and rows[2]["length"] == 3
