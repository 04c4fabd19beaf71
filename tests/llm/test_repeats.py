"""Removal of repeated byte strings against a table of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from brightlake.llm import queries, repeats
from tests.llm.helpers import SF, edge_rows, edge_table


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept bytes) of each text."""
    raw = [(t or "").encode() for t in texts]
    found = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - length + 1):
            if found[r[i:i + length]] > 1:
                gone[i:i + length] = True
        gone = gone[:len(r)]
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(r) else 0
        out.append((len(r), int(gone.sum()), spans, bytes(b for b, g in zip(r, gone) if not g)))
    return out


def digest(rows):
    return Counter((k, n, m, s, hashlib.sha256(kept).hexdigest()) for k, (n, m, s, kept) in rows)


def result(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("v", [1, 3, 7, 13, 31, 57, 183])
def test_difference_covers_hold_every_difference(v):
    cover = repeats.difference_cover(v)
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    assert v == 1 or len(cover) * (len(cover) - 1) + 1 == v


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = queries.QUERIES["op12_suffix_array_dedup"](spark, SF)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    expect = digest(zip((k for k, _ in docs), brute([t for _, t in docs], 400)))
    assert Counter(map(tuple, out.collect())) == expect
    assert any(0 < n < m for _, m, n, _, _ in expect)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("covers", [(7, 3, 1), (3, 1), (1,)])
def test_small_alphabets_equal_brute_force(spark, monkeypatch, seed, covers):
    rng = random.Random(seed)
    pieces = ["".join(rng.choice("ab" if seed % 2 else "abcdé") for _ in range(rng.randint(1, 30)))
              for _ in range(12)]
    texts = ["".join(rng.choice(pieces) if rng.random() < .5 else rng.choice("xyz" * 9 + "é")
                     for _ in range(rng.randint(0, 12))) for _ in range(60)]
    texts += ["a" * 25, "ab" * 20, texts[5], texts[5], texts[6], None, ""]
    monkeypatch.setattr(repeats, "BLOCK_PLACES", 40)
    monkeypatch.setattr(repeats, "PART_PLACES", 300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = repeats.find_repeats(docs, length=12, covers=covers)
    assert result(out) == digest(enumerate(brute(texts, 12)))


def test_edge_rows_and_kept_bytes(spark):
    rows = edge_rows()
    expect = brute([r[1] for r in rows], 400)
    docs = edge_table(spark)
    assert result(repeats.find_repeats(docs)) == digest(zip((r[0] for r in rows), expect))
    kept = repeats.remove_repeats(docs)
    assert kept.columns == [*docs.columns, "kept_bytes"]
    assert Counter((r.doc_id, bytes(r.kept_bytes)) for r in kept.collect()) == \
        Counter((r[0], e[3]) for r, e in zip(rows, expect))


def test_empty_table(spark):
    assert repeats.find_repeats(edge_table(spark, [])).collect() == []
