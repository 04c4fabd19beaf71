"""What the pipeline's passes take in a worker process, whatever the texts' lengths."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from brightlake.llm import quality, text, toxicity
from brightlake.llm.neardup import similar

BUCKETS = np.arange(0, toxicity.BUCKETS, toxicity.BUCKETS // toxicity.FEATURES)
MODEL = toxicity.Model(BUCKETS, np.linspace(-1, 1, len(BUCKETS)), 0.25)


def peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def lines(rows: int, words: int) -> pa.Array:
    draw = np.random.default_rng(3).integers(0, 5000, (rows, words))
    return pa.array([" ".join(f"w{x}" for x in r) for r in draw])


def scan_quality(texts):
    for _, _, chunk in quality.chunks(texts, limit=quality.SMALL_BYTES):
        quality.base_failed(quality.base_counts(chunk))


def test_scores_of_many_short_texts_take_little_memory():
    texts = lines(30_000, 5)
    assert peak_mb(lambda: MODEL.scores(texts)) < 64


@pytest.mark.parametrize("work", [
    scan_quality, lambda t: similar(t, t, 4, 80), MODEL.scores], ids=["quality", "similar", "toxicity"])
def test_passes_take_little_memory(work, monkeypatch):
    for tables in (text._powers, text._prime_powers):
        monkeypatch.setattr(text, "_powers" if tables is text._powers else "_prime_powers",
                            [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    texts = lines(2_000, 300)
    assert peak_mb(lambda: work(texts)) < 48


def test_scores_are_those_of_single_texts():
    texts = pa.array(["", None, "ab", "some words here", "x" * 3000, *lines(1500, 4).to_pylist()])
    together = MODEL.scores(texts)
    alone = [MODEL.scores(texts.slice(i, 1))[0] for i in range(len(texts))]
    assert together.tolist() == alone
    for i in (3, 4, 700):
        held = next(found for _, found in toxicity.gram_buckets(texts.slice(i, 1)))
        margin = MODEL.bias + MODEL.weights[np.isin(BUCKETS, held)].sum()
        assert together[i] == pytest.approx(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def test_chunks_hold_as_many_rows_as_asked():
    texts = pa.array(["a", "", "bc", None, "d" * 50, "e"])
    found = [(first, end) for first, end, _ in text.chunks(texts, rows=2, limit=40)]
    assert found == [(0, 2), (2, 4), (4, 5), (5, 6)]
