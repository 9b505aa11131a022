"""Quality rules as a short-circuit cascade.

Every rule rejects a text by one inequality between counts. On a sample, all rules are run over all texts and timed;
the cascade then runs them by rejections per second, best first, each only on the texts that no earlier rule rejected.
The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices
from .measures import Measures


@dataclass(frozen=True)
class Rule:
    """Rejects where `rejects` is true; thresholds are fractions of integers, so no rounding is involved."""

    name: str
    rejects: Callable[[Measures], np.ndarray]


#: The base rules of the contract; a text that they reject fails whatever the others say.
def base_failed(m: Measures) -> np.ndarray:
    return (m.n_words() < 50) | (100 * m.n_repeat_words() > 50 * m.n_words())


RULES = (
    Rule("symbols", lambda m: 5 * m.count("symbol") > m.n_words()),
    Rule("capitals", lambda m: 10 * m.count("upper") > 3 * m.word_chars()),
    Rule("digits", lambda m: 10 * m.count("digit") > 3 * m.word_chars()),
    Rule("exclamations", lambda m: 2 * m.count("shout") > m.n_words()),
    Rule("short words", lambda m: m.word_chars() < 2 * m.n_words()),
    Rule("long words", lambda m: m.word_chars() > 12 * m.n_words()),
    Rule("repeated lines", lambda m: 10 * m.n_dup_lines() > 4 * m.n_lines()),
    Rule("few different words", lambda m: 10 * m.n_distinct_words() < m.n_words()),
)

SLICE = 2 << 20
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _trial(rules: tuple[Rule, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seconds and rejections of every rule on fresh measures, so that no rule profits from another's counts."""
    for part in byte_slices(batches, "text", SLICE):
        rows = []
        for k, rule in enumerate(rules):
            began = time.process_time()
            rejected = int(rule.rejects(Measures(part.column("text"))).sum())
            rows.append((k, time.process_time() - began, rejected))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["rule", "seconds", "rejected"])


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 500) -> tuple[Rule, ...]:
    """The rules by rejections per second on a sample of rows, best first; as given where the sample is empty."""
    trial = docs.limit(sample_rows).mapInArrow(lambda it: _trial(rules, it), "rule long, seconds double, rejected long")
    found = trial.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()
    worth = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in found}
    return tuple(rules[k] for k in sorted(range(len(rules)), key=lambda k: (-worth.get(k, 0), k)))


def cascade(texts: pa.Array, rules: tuple[Rule, ...], kept: np.ndarray) -> np.ndarray:
    """`kept` without the texts that a rule rejects; each rule sees only what is still kept."""
    kept = kept.copy()
    measures, alive = None, None
    for rule in rules:
        if not kept.any():
            break
        if alive is None or kept.sum() < 0.8 * len(alive):  # enough went to pay for a smaller batch
            alive = np.flatnonzero(kept)
            measures = Measures(texts.take(pa.array(alive)))
        kept[alive[rule.rejects(measures)]] = False
    return kept


def _judge(rules: tuple[Rule, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in byte_slices(batches, "text", SLICE):
        texts = part.column("text")
        m = Measures(texts)
        failed = base_failed(m)
        columns = [m.n_words(), m.word_chars(), m.count("symbol"), m.n_dup_lines(), m.n_repeat_words(), failed,
                   cascade(texts, rules, ~failed)]
        names = ["doc_id", *(c.split()[0] for c in COUNTS.split(", ")), "base_failed", "kept"]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, columns)], names=names)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept; one row per row.

    A null or empty text has no words and fails. Rows are judged alone: repeated rows and null ids get results like
    others, an empty table gives none, other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = order_rules(rows, rules)
    schema = f"doc_id long, {COUNTS}, base_failed boolean, kept boolean"
    return rows.mapInArrow(lambda it: _judge(ordered, it), schema)
