"""Importance resampling against a plain count over single texts."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brightlake.llm import importance, queries
from tests.llm.helpers import LOWER, SCHEMA, SF, edge_rows, edge_table

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, n=1, buckets=10000, min_words=20, percent=10, seed=2024):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = Counter(), Counter()
    for bag, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            bag.update(map(bucket, grams(text, n)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
            for b in range(buckets)}
    rows = []
    for key, text in docs:
        words, found = grams(text, n)
        weight = sum(gain[bucket(g)] for g in found) // len(found) if found else 0
        name = f"{seed}:{'' if key is None else key}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None, len(words)])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return Counter(tuple(r[:5]) for r in rows)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = queries.QUERIES["op13_importance_resampling"](spark, SF)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in out.dtypes} == {"bigint"}
    assert Counter(map(tuple, out.collect())) == brute(docs, target)


@pytest.mark.parametrize("n", [1, 3])
def test_edge_rows(spark, n):
    rows = [(r[0], r[1]) for r in edge_rows()]
    target = ["one two three", "", None]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    out = importance.draw(edge_table(spark), goal, n=n, percent=50, min_words=2)
    assert Counter(map(tuple, out.collect())) == brute(rows, target, n, percent=50, min_words=2)


def test_ngrams_stay_in_their_document():
    texts = [b"a b", b"", b"c", b"\x00d\x00e f", "É g".encode()]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    rows, found, words = importance.batch_features(
        np.frombuffer(b"".join(texts), np.uint8), offsets, 2, 10**9)
    expect = Counter((i, zlib.crc32(g.encode()) % 10**9) for i, t in enumerate(texts)
                     for g in grams(t.decode(), 2)[1])
    assert Counter(zip(rows.tolist(), found.tolist())) == expect
    assert words.tolist() == [2, 0, 1, 3, 2]


def test_resample_returns_whole_rows_once(spark):
    docs = edge_table(spark)
    goal = spark.createDataFrame([("one two three",)], "text string")
    ranks = importance.draw(docs, goal, percent=60, min_words=0)
    out = importance.resample(docs, goal, percent=60, min_words=0)
    assert out.columns == docs.columns
    expect = Counter(r[0] for r in ranks.filter("rank IS NOT NULL").collect())
    assert Counter(r.doc_id for r in out.collect()) == expect
    assert sum(expect.values()) == 60 * len(edge_rows()) // 100


def test_empty_tables(spark):
    empty = edge_table(spark, [])
    goal = spark.createDataFrame([], "text string")
    assert importance.draw(empty, goal).collect() == []
    some = spark.createDataFrame([(1, "a b", "en", "x", 3)], SCHEMA)
    assert [r.rank for r in importance.draw(some, goal, min_words=1, percent=100).collect()] == [1]
