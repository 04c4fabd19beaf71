"""Quality rules as a short-circuit cascade.

Each rule sees only the documents that all earlier rules kept. Cost and
rejection rate of every rule are estimated on a sample, and rules run in the
order of rejection per cost, so cheap and selective rules spare the dear ones
their work. A document is kept when every rule keeps it, so the order changes
the time taken and never the verdict.

Defined cases: a null or empty text has no words and fails the base rule; a
null id is kept as it is; equal rows get equal verdicts; other columns of the
input are ignored by ``score_quality`` and carried along by ``keep_good``.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightlake.llm.text import IS_SPACE, SMALL_BYTES, Chunk, chunks

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Documents that the cost estimate looks at, about.
SAMPLE_ROWS = 2000

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _lines(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every newline-split line."""
    breaks = np.flatnonzero(chunk.data == 10)
    row_of_break = np.searchsorted(chunk.offsets, breaks, side="right") - 1
    starts = np.concatenate([chunk.offsets[:-1], breaks + 1])
    rows = np.concatenate([np.arange(chunk.n), row_of_break])
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    if len(ends):
        ends[-1] = chunk.offsets[-1]
    last = np.ones(len(rows), dtype=bool)
    last[:-1] = rows[1:] != rows[:-1]
    ends[last] = chunk.offsets[1:]
    return starts, ends, rows


def duplicate_lines(chunk: Chunk) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same text."""
    starts, ends, rows = _lines(chunk)
    word_starts = chunk.words()[0]
    has_word = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends, rows = starts[has_word], ends[has_word], rows[has_word]
    hashes = chunk.span_hash(starts, ends)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    again = (rows[1:] == rows[:-1]) & (hashes[1:] == hashes[:-1])
    return np.bincount(rows[1:][again], minlength=chunk.n)


def repeated_words(chunk: Chunk, window: int = 3) -> np.ndarray:
    """Words inside a word window that occurs twice or more in the same text."""
    hashes, rows = chunk.word_hashes(), chunk.words()[2]
    n = len(rows) - window + 1
    if n <= 0:
        return np.zeros(chunk.n, dtype=np.int64)
    inside = rows[:n] == rows[window - 1:]
    value = np.zeros(n, dtype=np.uint64)
    for j in range(window):
        value = value * np.uint64(0x9E3779B97F4A7C15) + hashes[j:n + j]
        value ^= value >> np.uint64(31)
    at = np.flatnonzero(inside)
    order = at[np.lexsort((value[at], rows[at]))]
    same = (rows[order][1:] == rows[order][:-1]) & (value[order][1:] == value[order][:-1])
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    found = order[twice]
    covered = np.zeros(len(rows), dtype=bool)
    for j in range(window):
        covered[found + j] = True
    return np.bincount(rows[covered], minlength=chunk.n)


def base_counts(chunk: Chunk) -> dict[str, np.ndarray]:
    """The counts that every document gets, whatever the verdict."""
    first_bytes = (chunk.data & 0xC0) != 0x80
    space = IS_SPACE[chunk.data]
    return {"n_words": chunk.word_counts(),
            "word_chars": chunk.sums_by_row(first_bytes & ~space),
            "n_symbols": chunk.sums_by_row(_SYMBOL[chunk.data]),
            "n_dup_lines": duplicate_lines(chunk),
            "n_repeat_words": repeated_words(chunk)}


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    words = counts["n_words"]
    return (words < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * words)


@dataclass(frozen=True)
class Rule:
    """``rejects(chunk)`` marks the rows of a chunk that the rule turns down."""
    name: str
    rejects: Callable[[Chunk], np.ndarray]


def _symbols(chunk: Chunk) -> np.ndarray:
    return 10 * chunk.sums_by_row(_SYMBOL[chunk.data]) > chunk.word_counts()


def _shouting(chunk: Chunk) -> np.ndarray:
    upper = chunk.sums_by_row(_UPPER[chunk.data])
    return 10 * upper > 3 * chunk.sums_by_row(_LETTER[chunk.data])


def _exclaiming(chunk: Chunk) -> np.ndarray:
    return 10 * chunk.sums_by_row(chunk.data == 33) > chunk.word_counts()


def _few_letters(chunk: Chunk) -> np.ndarray:
    solid = chunk.sums_by_row(chunk.data > 32)
    return 10 * chunk.sums_by_row(_LETTER[chunk.data]) < 6 * solid


def _word_length(chunk: Chunk) -> np.ndarray:
    points = chunk.sums_by_row(((chunk.data & 0xC0) != 0x80) & (chunk.data > 32))
    words = chunk.word_counts()
    return (points < 2 * words) | (points > 15 * words)


def _line_copies(chunk: Chunk) -> np.ndarray:
    lines = chunk.sums_by_row(chunk.data == 10) + 1
    return 2 * duplicate_lines(chunk) > lines


def _phrase_copies(chunk: Chunk) -> np.ndarray:
    return 10 * repeated_words(chunk, 5) > 4 * chunk.word_counts()


RULES = (Rule("symbols", _symbols), Rule("shouting", _shouting),
         Rule("exclaiming", _exclaiming), Rule("few_letters", _few_letters),
         Rule("word_length", _word_length), Rule("line_copies", _line_copies),
         Rule("phrase_copies", _phrase_copies))


def order_rules(docs: DataFrame, rules=RULES, text: str = "text",
                sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by estimated rejection per second, on about ``sample_rows`` documents.

    The sample only decides the order, so it never changes a verdict. Each
    task returns one row per rule, and those are summed before the driver
    sees them.
    """
    spark = docs.sparkSession
    total = docs.count()
    if not total:
        return list(rules)
    share = max(1, total // sample_rows)
    sample = docs.select(text).filter(F.pmod(F.xxhash64(text, F.length(text)), F.lit(share)) == 0)

    def measure(batches):
        spent, turned, seen = np.zeros(len(rules)), np.zeros(len(rules)), 0
        for batch in batches:
            for _, _, chunk in chunks(batch.column(0), limit=SMALL_BYTES):
                seen += chunk.n
                for i, rule in enumerate(rules):
                    alone = Chunk(chunk.data, chunk.offsets)
                    began = time.perf_counter()
                    turned[i] += rule.rejects(alone).sum()
                    spent[i] += time.perf_counter() - began
        if seen:
            yield pa.RecordBatch.from_pydict({"rule": np.arange(len(rules), dtype=np.int32), "spent": spent,
                                              "turned": turned})

    found = (sample.mapInArrow(measure, "rule int, spent double, turned double")
             .groupBy("rule").agg(F.sum("spent").alias("spent"), F.sum("turned").alias("turned"))
             .collect())
    worth = {r["rule"]: r["turned"] / max(r["spent"], 1e-9) for r in found}
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-worth.get(i, 0.0), i))]


def run_cascade(chunk: Chunk, rules, alive: np.ndarray) -> np.ndarray:
    """The rows of ``alive`` (a mask) that no rule turns down."""
    kept = alive.copy()
    rows = np.flatnonzero(kept)
    part = chunk if len(rows) == chunk.n else None
    for rule in rules:
        if not len(rows):
            break
        part = part if part is not None else chunk.keep(rows)
        rejected = rule.rejects(part)
        if rejected.any():
            kept[rows[rejected]] = False
            rows, part = rows[~rejected], None
    return kept


SCORE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def score_quality(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  rules=RULES) -> DataFrame:
    """``key``, the base counts, ``base_failed`` and ``kept`` of every document."""
    ordered = order_rules(docs, rules, text)
    kind = docs.schema[key].dataType.simpleString()

    def score(batches):
        for batch in batches:
            for first, end, chunk in chunks(batch.column(1), limit=SMALL_BYTES):
                counts = base_counts(chunk)
                failed = base_failed(counts)
                kept = run_cascade(chunk, ordered, ~failed)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first),
                     *[pa.array(counts[c], pa.int64()) for c in SCORE_COLUMNS],
                     pa.array(failed), pa.array(kept)],
                    [key, *SCORE_COLUMNS, "base_failed", "kept"])

    return docs.select(key, text).mapInArrow(
        score, f"`{key}` {kind}, " + ", ".join(f"{c} long" for c in SCORE_COLUMNS)
        + ", base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The documents that pass, with all their columns, unchanged."""
    ordered = order_rules(docs, rules, text)
    at = docs.columns.index(text)

    def good(batches):
        for batch in batches:
            for first, end, chunk in chunks(batch.column(at), limit=SMALL_BYTES):
                kept = run_cascade(chunk, ordered, ~base_failed(base_counts(chunk)))
                yield batch.slice(first, end - first).filter(pa.array(kept))

    return docs.mapInArrow(good, docs.schema)
