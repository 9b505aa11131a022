"""Spelling variants: words one edit apart, found by composing automata.

The vocabulary is a minimised acyclic acceptor A; T is the transducer that changes one code point; the accepted paths of
A, T and A composed are the pairs sought. The composition is cut by its initial states. A pair of words of c and c or
c + 1 code points agrees either on the first c // 2 or on the last c - c // 2 of them, so each word is read from its
shared half on, and all words with one half (an initial state) are composed by themselves. An initial state with too many
words is cut again in the same way, inside what is left of its words, as often as needed; nothing is dropped.

Inside a task words carry no objects: states and arcs are arrays, every arc knows how many words come before it, so a
pair of paths is a pair of word numbers, and the frontier of the composition is expanded level by level. Where both
sides reach the same state, what remains of them is the same language in the same order, and the pairs are read off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, mix, raw, runs

#: Letters of a word, of ISO 8859-1: one byte each in that encoding.
LETTER = "[A-Za-zÀ-ÿ]"
#: Words (each once per initial state that it belongs to) of one task, and the most of one initial state.
SHARD = 1 << 18
#: Elements of the frontier that are expanded at once.
FRONTIER = 1 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2,
               every: int = 31) -> DataFrame:
    """(word, n): the lower-cased words and how often they occur; about one in `every` runs is read with a letter missing."""
    # No shorter run can give a word, since only deletions change its length.
    text = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"{LETTER}{{{min_length},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(text).alias("run"))
    rows = rows.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    return rows.select(word.alias("word")).where(F.length("word") >= min_length).groupBy("word").agg(
        F.count("*").alias("n")).where(F.col("n") >= min_count)


# ---------------------------------------------------------------- one class of initial states


class Acceptor:
    """The minimised acceptor of sorted words, each under an initial state of its own group.

    `rows` holds the words as padded bytes, `sizes` their lengths, `shared` the length that a word has in common with the
    one before (-1: it begins a group). Nodes of the trie are numbered by depth, then in word order; nodes with the same
    language are one state.
    """

    def __init__(self, rows: np.ndarray, sizes: np.ndarray, shared: np.ndarray):
        start, end, char, parent, final = [], [], [], [], []
        base = 0
        for d in range(rows.shape[1] + 1):
            bound = np.flatnonzero(shared < d)
            stop = np.append(bound[1:], len(rows))
            there = sizes[bound] >= d
            if not there.any():
                break
            s = bound[there]
            parent.append(np.searchsorted(start[-1], s, side="right") - 1 + base if d else np.full(len(s), -1))
            base += len(start[-1]) if d else 0
            char.append(rows[s, d - 1] if d else np.zeros(len(s), np.uint8))
            start.append(s)
            end.append(stop[there])
            final.append(sizes[s] == d)
        per_depth = [len(s) for s in start]
        self.start, self.final = np.concatenate(start), np.concatenate(final)
        size = np.concatenate(end) - self.start
        roots, n = per_depth[0], len(self.start)
        # Arcs lead to all nodes but the roots, in the order of their sources.
        self.source, self.target_node = np.concatenate(parent)[roots:], np.arange(roots, n)
        self.char = np.concatenate(char)[roots:].astype(np.int64)
        self.n_arcs = np.bincount(self.source, minlength=n)
        self.first_arc = np.cumsum(self.n_arcs) - self.n_arcs
        language = np.where(self.final, np.uint64(0x9E3779B97F4A7C15), np.uint64(0x632BE59BD9B4E019))
        above = n
        for width in reversed(per_depth[1:]):
            low = above - width
            arcs = slice(low - roots, above - roots)
            np.add.at(language, self.source[arcs], mix(mix(self.char[arcs].astype(np.uint64) + np.uint64(1)) ^ language[low:above]))
            above = low
        _, leader, self.state = np.unique(language, return_index=True, return_inverse=True)
        if not self._same_languages(leader):
            leader = self.state = np.arange(n)
        # The arcs of each state are those of its leader; a word's number grows by `skip` along an arc.
        self.end_here = self.final[leader]
        self.words = size[leader]
        self.out = self.n_arcs[leader]
        self.out_first = np.cumsum(self.out) - self.out
        arcs = np.repeat(self.first_arc[leader] - self.out_first, self.out) + np.arange(self.out.sum())
        self.to = self.state[self.target_node[arcs]]
        self.skip = self.start[self.target_node[arcs]] - self.start[self.source[arcs]]
        self.letter = self.char[arcs]
        self.key = np.repeat(np.arange(len(leader)), self.out) * 256 + self.letter

    def _same_languages(self, leader: np.ndarray) -> bool:
        """Whether nodes of one hash really have the same end mark and the same arcs to the same states."""
        of = leader[self.state]
        if not (np.array_equal(self.final, self.final[of]) and np.array_equal(self.n_arcs, self.n_arcs[of])):
            return False
        twin = np.arange(len(self.source)) - self.first_arc[self.source] + self.first_arc[of[self.source]]
        return np.array_equal(self.char, self.char[twin]) and np.array_equal(
            self.state[self.target_node], self.state[self.target_node[twin]])

    def edited(self):
        """Elements (state, word, state, word, banned) just behind the edit: two arcs of a node, or an arc on one side.

        An inserted letter is the last of a run of itself: the next letter must be another one, so each pair comes once.
        """
        of = self.source
        arc = np.arange(len(of))
        later = self.first_arc[of] + self.n_arcs[of] - arc - 1
        cuts = np.append(np.searchsorted(np.cumsum(later), np.arange(0, later.sum() + 1, FRONTIER)), len(of))
        for a, b in zip(cuts, cuts[1:]):
            n = later[a:b]
            if not n.sum():
                continue
            left = np.repeat(arc[a:b], n)
            right = left + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            left, right = self.target_node[left], self.target_node[right]
            yield self.state[left], self.start[left], self.state[right], self.start[right], None
        for a in range(0, len(of), FRONTIER):
            left, right = of[a : a + FRONTIER], self.target_node[a : a + FRONTIER]
            yield self.state[left], self.start[left], self.state[right], self.start[right], self.char[a : a + FRONTIER]

    def pairs(self):
        """Numbers (i, j) of words one edit apart, in arrays; word j is the longer one, if lengths differ."""
        todo = []
        for element in self.edited():
            todo.append(element)
            while todo:
                s, i, t, j, banned = todo.pop()
                if len(s) > FRONTIER:
                    half = len(s) // 2
                    todo += [(s[:half], i[:half], t[:half], j[:half], banned if banned is None else banned[:half]),
                             (s[half:], i[half:], t[half:], j[half:], banned if banned is None else banned[half:])]
                    continue
                both = s == t
                if both.any():
                    n = self.words[s[both]]
                    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    yield np.repeat(i[both], n) + step, np.repeat(j[both], n) + step
                    s, i, t, j = s[~both], i[~both], t[~both], j[~both]
                    banned = banned if banned is None else banned[~both]
                ends = self.end_here[s] & self.end_here[t]
                if ends.any():
                    yield i[ends], j[ends]
                n = self.out[s]
                of = np.repeat(np.arange(len(s)), n)
                arc = np.repeat(self.out_first[s], n) + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                wanted = t[of] * 256 + self.letter[arc]
                other = np.minimum(np.searchsorted(self.key, wanted), max(len(self.key) - 1, 0))
                go = self.key[other] == wanted if len(self.key) else np.zeros(0, bool)
                if banned is not None:
                    go &= self.letter[arc] != banned[of]
                of, arc, other = of[go], arc[go], other[go]
                if len(of):
                    todo.append((self.to[arc], i[of] + self.skip[arc], self.to[other], j[of] + self.skip[other], None))


def _padded(words: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = raw(words)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width), np.uint8)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(data)) - np.repeat(offsets[:-1], sizes)] = data
    return out, sizes


def _near_in_class(words: pa.Array, c: int, a: int, b: int, x: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one class: words that agree on `a` leading and `b` trailing letters and are one edit apart there.

    Two words with more than c letters, and pairs that agree on the first x letters, belong to another class.
    """
    whole, length = _padded(words, c + 1)
    turned = np.zeros((len(whole), c + 1), np.uint8)  # the shared letters first
    for size in (c, c + 1):
        at = np.flatnonzero(length == size)
        turned[at, :a] = whole[at, :a]
        turned[at, a : a + b] = whole[at, size - b : size]
        turned[at, a + b : size] = whole[at, a : size - b]
    order = np.argsort(turned.view(f"S{c + 1}").ravel(), kind="stable")

    def shared_with_last(rows):
        out = np.full(len(rows), -1)
        if len(rows) > 1:
            out[1:] = np.argmin(np.column_stack([rows[1:] == rows[:-1], np.zeros(len(rows) - 1, bool)]), axis=1) - a - b
        return np.maximum(out, -1)

    shared = shared_with_last(turned[order])
    alone = (shared < 0) & np.append(shared[1:] < 0, True)
    order = order[~alone]
    if not len(order):
        return order, order
    rows, sizes = turned[order], length[order] - a - b
    left, right = [], []
    for i, j in Acceptor(rows[:, a + b :], sizes, shared_with_last(rows)).pairs():
        i, j = order[i], order[j]
        stay = np.minimum(length[i], length[j]) == c
        if x >= 0:
            stay &= (whole[i, :x] != whole[j, :x]).any(axis=1)
        left.append(i[stay])
        right.append(j[stay])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


NEAR = "word binary, n_near long, near_n long, near binary"


def _near(table: pa.Table) -> pa.Table:
    """For each word of a shard's initial states: how many words are near it there, and the most frequent of them."""
    columns = [table.column(k).to_numpy() for k in ("c", "a", "b", "x")]
    words = table.column("word").combine_chunks()
    order = np.lexsort(columns)
    new = np.any([runs(k[order]) for k in columns], axis=0) if len(order) else np.zeros(0, bool)
    cuts = np.append(np.flatnonzero(new), len(order))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p, q in zip(cuts, cuts[1:]):
        at = order[p:q]
        i, j = _near_in_class(words.take(pa.array(at)), *(int(k[at[0]]) for k in columns))
        left += [at[i], at[j]]
        right += [at[j], at[i]]
    left, right = np.concatenate(left), np.concatenate(right)
    n, rank = table.column("n").to_numpy(), np.empty(len(words), np.int64)
    rank[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
    by = np.lexsort((rank[right], -n[right], left))
    left, right = left[by], right[by]
    first = np.flatnonzero(runs(left)) if len(left) else left
    return pa.table({
        "word": words.take(pa.array(left[first])), "n_near": pa.array(np.diff(np.append(first, len(left)))),
        "near_n": pa.array(n[right[first]]), "near": words.take(pa.array(right[first])),
    }, schema=pa.schema([("word", pa.binary()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.binary())]))


# ---------------------------------------------------------------- all initial states

_STATE = ["c", "a", "b", "x", "head", "tail"]


def _entries(words: DataFrame, min_length: int) -> DataFrame:
    """Each word with the initial states that it belongs to: as the shorter word of a pair, and as the longer one."""
    pieces = F.expr(f"""flatten(transform(filter(array(length(word), length(word) - 1), c -> c >= {min_length}), c -> array(
        struct(c, c div 2 AS a, 0 AS b, -1 AS x), struct(c, 0 AS a, c - c div 2 AS b, c div 2 AS x))))""")
    return _states(words.select("word", "n", F.inline(pieces)))


def _states(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("word", "n", *(f"cast({k} AS int) AS {k}" for k in "cabx"), "left(word, a) AS head", "right(word, b) AS tail")


def _narrowed(entries: DataFrame) -> DataFrame:
    """Entries of an initial state cut in two: those that agree on the next letters as well, or on the last ones."""
    g = "((c - a - b) div 2)"
    pieces = F.expr(f"""array(struct(c AS c2, a + {g} AS a2, b AS b2, x AS x2),
        struct(c AS c2, a AS a2, c - a - {g} AS b2, if(x < 0 or a + {g} < x, a + {g}, x) AS x2))""")
    rows = entries.select("word", "n", "a", "b", "c", "x", F.inline(pieces))
    return _states(rows.selectExpr("word", "n", "c2 AS c", "a2 AS a", "b2 AS b", "x2 AS x"))


def near_words(words: DataFrame, min_length: int = 7, limit: int = SHARD) -> DataFrame:
    """(word, n_near, near_n, near): the number of near words of each word that has any, and the most frequent of them."""
    entries = _entries(words, min_length)
    while True:
        # Initial states with more words than fit a task are narrowed until none is left; their counts decide, not texts.
        large = entries.groupBy(*_STATE).count().where((F.col("count") > limit) & (F.col("c") - F.col("a") - F.col("b") >= 2))
        large = keep(large.drop("count"))
        if large.isEmpty():
            break
        rest = entries.join(large, _STATE, "left_anti")
        entries = keep(rest.unionByName(_narrowed(entries.join(large, _STATE, "left_semi"))))
    shards = max(1, -(-entries.count() // limit))
    dealt = entries.select(
        F.pmod(F.xxhash64(*_STATE), F.lit(shards)).alias("shard"), F.encode("word", "ISO-8859-1").alias("word"), "n", "c", "a", "b", "x")
    found = dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(_near, NEAR)
    found = found.select(F.decode("word", "ISO-8859-1").alias("word"), "n_near", "near_n", F.decode("near", "ISO-8859-1").alias("near"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root): the last word of each chain of forms. Every round doubles the length that is followed."""
    roots = forms.select("word", F.col("form").alias("root"))
    reach = 1
    while reach < steps:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        roots = keep(roots.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")))
        reach *= 2
    return roots


def variants(words: DataFrame, min_length: int = 7, times: int = 10, limit: int = SHARD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of `words` (word, n), a table of distinct words.

    Words are near if one code point inserted, deleted or replaced makes them equal. A word's form is its most frequent
    near word (of equal ones the first in code-point order) if that occurs at least `times` as often as the word; root
    follows forms to the last one. Words hold ISO 8859-1 letters only, and have `min_length` code points or more.
    An empty table gives an empty one.
    """
    near = keep(near_words(words, min_length, limit))
    joined = words.join(near, "word", "left")
    has = F.col("near_n") >= times * F.col("n")
    joined = keep(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("near")).alias("form"),
        F.when(has, F.col("near_n")).alias("form_n")))
    # Each form is `times` as frequent as the word before, so the highest count bounds the length of a chain.
    top, steps = joined.agg(F.max("form_n")).first()[0] or 0, 0
    while top >= times:
        top, steps = top // times, steps + 1
    roots = _roots(joined.where("form IS NOT NULL"), steps)
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2,
                      every: int = 31, times: int = 10) -> DataFrame:
    """The words of whole texts with their near words and forms (see `vocabulary` and `variants`).

    A null or empty text has no words; a null id counts as an empty string; repeated rows count each. Very long runs are
    words like others. Other columns are not read, whatever their names.
    """
    return variants(keep(vocabulary(docs, id_col, text_col, min_length, min_count, every)), min_length, times)
