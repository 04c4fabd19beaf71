"""Collocations against plain counting of every phrase."""

import random
import re
from collections import Counter, defaultdict

import pytest
from brightlake.llm import phrases, queries
from tests.llm.helpers import LOWER, SF, edge_rows, edge_table

PIECE, WORD = re.compile("[.,;:!?\x0A-\x0D]"), re.compile("[^\x20\x09]+")


def brute(docs, top, min_count=10, cover=50):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(LOWER)):
            w = WORD.findall(piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        longest = Counter()
        for p, a in f.items():
            if len(p) == 3 and a >= min_count:
                for q in (p[:2], p[1:]):
                    longest[q] = max(longest[q], a)
        rows = []
        for p, a in f.items():
            if len(p) == 1 or a < min_count or (longest[p] and 100 * longest[p] >= cover * a):
                continue
            score, _, left, right = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                        for k in range(1, len(p)))
            rows.append((" ".join(p), a, left, right, total[lang], score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(rows[:top])]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.collect()))


def test_query_equals_brute_force(spark):
    docs = [(r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = queries.QUERIES["op11_collocations"](spark, SF)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert all(t == "bigint" for c, t in out.dtypes if c not in ("lang", "phrase"))
    assert result(out) == brute(docs, 2000)


@pytest.mark.parametrize("top,first", [(5, 2), (40, 1), (1000, 2)])
def test_thresholds_fall_until_settled(spark, monkeypatch, top, first):
    rng = random.Random(top)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "x\x00y"]
    fixed = ["new york city", "a  b\tc", "of the", "red. fox", "one,two", "New York"]
    docs = [(" ".join(rng.choice(fixed) if rng.random() < .4 else rng.choice(vocabulary)
                      for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None, "und"]))
            for _ in range(150)]
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 300)
    monkeypatch.setattr(phrases, "FIRST", first)
    monkeypatch.setattr(phrases, "MIN_BITS", 16)
    table = spark.createDataFrame(docs, "text string, lang string").repartition(3)
    assert result(phrases.collocations(table, top=top, min_count=3)) == brute(docs, top, 3)


def test_full_bitmaps_lose_nothing(spark, monkeypatch):
    docs = [("a b c a b d. b c a", "en"), ("a b c " * 9, "en"), ("b c d " * 5, None)] * 4
    monkeypatch.setattr(phrases, "MIN_BITS", 16)
    monkeypatch.setattr(phrases, "MAX_BITS", 16)
    table = spark.createDataFrame(docs, "text string, lang string")
    assert result(phrases.collocations(table, top=10)) == brute(docs, 10)


def test_scores_of_large_counts_are_exact(spark):
    rows = [(10**15 - 1, 10**15, 10**15 - 1), (3 * 10**14 + 7, 10**15 - 3, 3 * 10**14 + 7)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    assert [r[0] for r in df.select(phrases._score("a", "l", "r")).collect()] == \
        [1000000 * a * a // (x * y) for a, x, y in rows]


def test_edge_rows_and_empty_table(spark):
    docs = [(r[1], r[2]) for r in edge_rows()]
    assert result(phrases.collocations(edge_table(spark), top=50)) == brute(docs, 50)
    assert phrases.collocations(edge_table(spark, [])).collect() == []
