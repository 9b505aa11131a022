"""Importance resampling, spelling variants and top-k search against brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.llm import spelling, target_sampling, topk_search
from tests.llm.test_operators import SCHEMA, docs, key, nothing, rows  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# ---------------------------------------------------------------- importance resampling

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = TOKEN.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_resample(rows, target, percent, min_words):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = Counter(), Counter()
    for r in rows:
        s.update(map(bucket, features(r[1])[1]))
    for x in target:
        t.update(map(bucket, features(x)[1]))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    out = []
    for r in rows:
        w, f = features(r[1])
        weight = sum(gain(bucket(x)) for x in f)
        h = int(hashlib.sha256(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    able = sorted((x for x in out if x[4] >= min_words), key=lambda x: (-x[3], key(x[0]), x[1], x[2]))
    ranks = Counter((*map(tuple, [x[:4]]), i + 1) for i, x in enumerate(able[: percent * len(able) // 100]))
    return out, ranks


@pytest.mark.parametrize("finish", [4096, 3])
def test_resample_matches_brute_force(spark, docs, rows, monkeypatch, finish):  # noqa: F811
    monkeypatch.setattr(target_sampling, "FINISH", finish)
    monkeypatch.setattr(target_sampling, "GROUP", 4)
    target = [rows[0][1], None, "", "Ünï ha HA ha 7"]
    table = spark.createDataFrame([(x,) for x in target], "text string")
    found = [tuple(r) for r in target_sampling.resample(docs, table, percent=30, min_words=5).drop("n_words").collect()]
    all_rows, ranks = brute_resample(rows, target, 30, 5)
    assert Counter(r[:4] for r in found) == Counter(tuple(x[:4]) for x in all_rows)
    assert Counter((r[:4], r[4]) for r in found if r[4]) == ranks


def test_resample_cases(spark, docs, nothing):  # noqa: F811
    target = spark.createDataFrame([("a b c",)], "text string")
    assert target_sampling.resample(nothing, target).count() == 0
    none = target_sampling.resample(docs, target.limit(0), min_words=10**6)
    assert none.where("rank IS NOT NULL").count() == 0 and none.count() == docs.count()


def test_one_row_many_times(spark):
    """A crowd of identical rows at the cut-off: exactly as many as asked for are drawn, with ranks of their own."""
    crowd = spark.range(400).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one two three " * 8).alias("text"))
    found = target_sampling.resample(crowd, crowd.limit(1))
    assert sorted(r[0] for r in found.where("rank IS NOT NULL").select("rank").collect()) == list(range(1, 21))


def test_long_text_in_pieces(spark, monkeypatch):
    """A text that is read in pieces scores as a whole one; a word longer than a piece stays one word."""
    r = random.Random(3)
    text = " ".join("".join(r.choice("abcdéü7") for _ in range(r.choice([1, 3, 9, 40, 700]))) for _ in range(300)) + "  ,, "
    gain = np.arange(10000) - 5000
    data = spark.createDataFrame([(1, text), (2, "a b"), (3, "," * 900)], "doc_id long, text string")
    whole = target_sampling.weights(data, gain).collect()
    monkeypatch.setattr(target_sampling, "CHUNK", 101)
    assert target_sampling.weights(data, gain).collect() == whole
    f = features(text)[1]
    assert whole[0][3] == sum(int(gain[zlib.crc32(x.encode()) % 10000]) for x in f) and whole[0][2] == len(f)


# ---------------------------------------------------------------- spelling variants


def brute_variants(words, times=10):
    near = {w: set() for w in words}
    letters = {c for w in words for c in w}
    for w in words:
        for i in range(len(w) + 1):
            for x in [w[:i] + w[i + 1 :]] + [w[:i] + c + w[j:] for c in letters for j in (i, i + 1) if j <= len(w)]:
                if x != w and x in words:
                    near[w].add(x)
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = top if top and words[top] >= times * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def variants_of(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("limit", [1 << 18, 3])
def test_variants_match_brute_force(spark, limit):
    r = random.Random(9)
    words = {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaabaaa", "é" * 7, "ÿ×÷ßÀbc", "ÿ×÷ßÀbcd"}
    for _ in range(60):
        w = "".join(r.choice("abcé") for _ in range(r.randint(7, 12)))
        words.add(w)
        for _ in range(6):
            i, c = r.randrange(len(w)), r.choice("abcé")
            w = r.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :]])
            if len(w) >= 7:
                words.add(w)
    words = {w: 2 * 12 ** r.randint(0, 4) for w in words}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert variants_of(spelling.variants(table, limit=limit)) == brute_variants(words)


def test_long_words_and_equal_languages(spark):
    """Long words, and a hash of two languages that agrees by accident: then no states are merged, the pairs stay right."""
    words = {"x" * 3000: 50, "x" * 2999: 5, "x" * 1500 + "y" + "x" * 1499: 2, "abcdefg": 30, "abcdefh": 3, "abcdeg": 1, "zbcdefg": 2}
    words = {w: n for w, n in words.items() if len(w) >= 7}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert variants_of(spelling.variants(table)) == brute_variants(words)


def test_states_are_not_merged_on_a_false_hash(monkeypatch):
    monkeypatch.setattr(spelling, "mix", lambda h: h * np.uint64(0))
    import pyarrow as pa

    words = sorted({"abcdxyz", "abcdxya", "abcfxyz", "abcfqya", "abcdxyzz"})
    i, j = spelling._near_in_class(pa.array([w.encode() for w in words]), 7, 3, 0, -1)
    found = {frozenset((words[a], words[b])) for a, b in zip(i, j)}
    assert found == {frozenset(x) for x in (("abcdxyz", "abcdxya"), ("abcdxyz", "abcfxyz"), ("abcdxyz", "abcdxyzz"))}


def test_vocabulary_matches_brute_force(spark, docs, rows, nothing):  # noqa: F811
    want = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            if h % 5 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += len(run) >= 4
    found = spelling.vocabulary(docs, min_length=4, every=5)
    assert {tuple(r) for r in found.collect()} == {(w, n) for w, n in want.items() if n >= 2}
    assert spelling.spelling_variants(nothing).count() == 0


# ---------------------------------------------------------------- top-k search

VECTORS = "vec_id long, embedding array<float>, rank int, score long, q long, shard string"


def brute_top(rows, k):
    able = []
    for vec_id, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            able.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for i, (query, v) in enumerate(able):
        if query is not None and query % 5 == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), key(o), o) for j, (o, w) in enumerate(able) if j != i]
            out += [(query, n + 1, o, -s) for n, (s, _, o) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def search(spark, rows, k=5):
    df = spark.createDataFrame([(*x, 1, 2, 3, "s") for x in rows], VECTORS).repartition(3)
    found = topk_search.top_k(df, df.where("vec_id % 5 = 0"), k)
    return Counter(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("shard", [1 << 20, 300])
def test_search_matches_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(topk_search, "SHARD", shard)
    g = np.random.default_rng(4)
    rows = [(i, g.normal(size=8).astype(float).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(400, 460)] + [(None, rows[5][1]), (None, rows[7][1]), (10, rows[11][1]), (15, rows[15][1])]
    rows += [(600, None), (605, []), (610, [1.0, None]), (615, [float("nan")] * 8), (620, [float("inf")] * 8), (625, [0.5, -2.0]),
             (630, [0.0] * 8), (635, [900000.0] * 8), (640, [-900000.0] * 8), (645, [1.0] * 11)]
    assert search(spark, rows) == brute_top(rows, 5)


def test_search_small_tables(spark):
    assert search(spark, [(5, [1.0]), (6, [2.0])]) == Counter([(5, 1, 6, 256 * 512)])
    assert search(spark, [(5, [1.0])]) == Counter()
    df = spark.createDataFrame([], VECTORS)
    assert topk_search.top_k(df, df).count() == 0


def test_search_stops_on_proof():
    """On clustered vectors a part of the postings is read, and the possible members include the best ones."""
    import pyarrow as pa

    g = np.random.default_rng(8)
    centres = g.normal(size=(20, 32)) * 40
    vectors = (centres[g.integers(0, 20, 4000)] + g.normal(size=(4000, 32)) * 5).astype(np.int64)
    table = pa.table({"shard": pa.array([0] * 4000), "vec": pa.array(vectors.tolist(), pa.list_(pa.int32())),
                      "ids": pa.array([[i] for i in range(4000)], pa.list_(pa.int64()))})
    shard = topk_search.Shard(topk_search._index(table).to_pylist()[0])
    for i in (3, 77, 2000):
        ids, score, own = shard.best(vectors[i], i, 6)
        want = sorted(range(4000), key=lambda j: (-int(vectors[j] @ vectors[i]), j))[:6]
        assert ids.tolist() == want and own.tolist() == [j == i for j in want] and shard.read < 1
