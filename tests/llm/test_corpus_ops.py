"""Near-dups, fingerprints, LM scores, sharding, mixing, toxicity: against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brightlake.llm import fingerprint, lm, mixing, neardup, sharding, toxicity
from brightlake.llm.text import chunks, fold
from tests.llm.helpers import (LOWER, SCHEMA, SF, edge_rows, edge_table, held_out, words)


def shingle_set(text, k):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k):
    sets = {}
    for key, text in rows:
        if key is not None:
            sets.setdefault(key, []).append(shingle_set(text, k))
    parent = {key: key for key in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        if any(s and 100 * len(s & t) >= 80 * len(s | t) for s in sets[a] for t in sets[b]):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {key: find(key) for key in sets}


def near_copies(n, seed):
    """A text and copies with a few words changed, dropped or added."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(400)}" for _ in range(60)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(6)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(50)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k", [4, 5])
def test_neardup_components(spark, k):
    texts = near_copies(40, 1) + near_copies(40, 2) + near_copies(3, 3)
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    rows += [(100 + i, *r[1:]) for i, r in enumerate(rows[:7])] + edge_rows()[4:]
    expect = brute_components([(r[0], r[1]) for r in rows], k)
    out = neardup.components(edge_table(spark, rows), words=k).collect()
    assert len(out) == len(rows)
    sizes = Counter((r[0], len(shingle_set(r[1], k))) for r in rows)
    assert Counter((r.doc_id, r.n_shingles) for r in out) == sizes
    for r in out:
        assert r.component_id == expect.get(r.doc_id) and r.kept == (r.doc_id == r.component_id)


def test_neardup_driver_documents_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expect = brute_components([(r.doc_id, r.text) for r in docs.collect()], 5)
    out = neardup.components(docs).collect()
    assert {r.doc_id: r.component_id for r in out} == expect
    table = edge_table(spark)
    kept = neardup.one_of_each(table)
    assert kept.columns == table.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[None] == 1 and ids[6] == 1 and ids[7] == 0 and ids[0] == ids[1] == 1
    assert neardup.components(edge_table(spark, [])).count() == 0
    assert neardup.one_of_each(edge_table(spark, [])).count() == 0


def test_neardup_keeps_one_row_of_null_and_repeated_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(None, a), (None, a), (None, a), (7, b), (7, b), (None, b), (9, b + " end"), (3, c), (3, "other")]
    docs = edge_table(spark, [(k, t, None, None, 0) for k, t in rows] + edge_rows())
    kept = Counter((r.doc_id, r.text) for r in neardup.one_of_each(docs).collect())
    assert kept[None, a] == 1 and kept[7, b] == 1 and kept[3, "one two"] == 1
    assert kept[None, b] == kept[9, b + " end"] == 0
    assert kept[3, c] == kept[3, "other"] == 1


def paragraphs(text):
    return {x.strip(" ") for x in re.split(r"\s*\n\s*", text)} - {""}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_recover_differences(spark):
    rnd = random.Random(5)
    rows = edge_rows()
    for i in range(60):
        lines = [f"p {rnd.randrange(3000)}" for _ in range(rnd.choice([1, 4, 30, 400, 3000]))]
        rows.append((100 + i, "\n".join(lines), None, None, 0))
    rows.append((200, rows[-1][1], None, None, 0))
    out = fingerprint.compare_versions(edge_table(spark, rows))
    got = out.collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [r[1] or "" for r in order]
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for i, r in enumerate(order):
        if r[0] == 3:
            continue   # repeated rows: either order of equals is the same text
        t, nxt = texts[i], texts[(i + 1) % len(texts)]
        half = len(t) // 2
        edited, o = t[:len(t) - half] + nxt[:half], by_id[r[0]]
        assert (o.n_chars, o.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert math.isclose(o.near_edited, jaccard(paragraphs(t), paragraphs(edited)))
        assert math.isclose(o.near_next, jaccard(paragraphs(t), paragraphs(nxt)))
    assert by_id[200].fingerprint == by_id[159].fingerprint
    assert by_id[0].fingerprint == by_id[1].fingerprint
    assert "Python" not in out._jdf.queryExecution().toString()
    assert fingerprint.compare_versions(edge_table(spark, [])).count() == 0


def test_peeling_finds_the_very_digests(spark):
    row = spark.range(1).select(
        F.array(*[F.lit(i).cast("long") for i in range(100, 130)]).alias("a"),
        F.array(*[F.lit(i).cast("long") for i in range(105, 133)]).alias("b")).select(
        fingerprint.peel(fingerprint.subtract(fingerprint.sketch(F.col("a")),
                                              fingerprint.sketch(F.col("b")))).alias("p")).first().p
    assert row.done and sorted(row.found) == [100, 101, 102, 103, 104, 130, 131, 132]


def brute_base(rows):
    count, ends = Counter(), 0
    for key, text in rows:
        if not held_out(key, 5):
            count.update(words((text or "").translate(LOWER)))
            ends += 1
    n = sum(count.values()) + ends
    d = n + 0.5 * (len(count) + (ends > 0) + 1)
    for key, text in rows:
        w = words((text or "").translate(LOWER))
        yield (key, held_out(key, 5), len(w) + 1, sum(x in count for x in w) + (ends > 0), n,
               sum(math.log10((count[x] + 0.5) / d) for x in w) + math.log10((ends + 0.5) / d))


def test_lm_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = edge_rows() + [tuple(r) for r in docs.select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect()]
    out = lm.score(edge_table(spark, rows), fold(F.col("doc_id"), 5) != 1).collect()
    expect = sorted(brute_base([(r[0], r[1]) for r in rows]), key=str)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)
                  for r in out), key=str)
    assert [g[:5] for g in got] == [e[:5] for e in expect]
    assert all(math.isclose(g[5], e[5], rel_tol=1e-9, abs_tol=1e-9) for g, e in zip(got, expect))
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    text_of, scores = {}, {}
    for k, t, *_ in rows:
        text_of.setdefault(k, set()).add((t or "").translate(LOWER))
    for r in out:
        if len(text_of[r.doc_id]) == 1:
            scores.setdefault(next(iter(text_of[r.doc_id])), set()).add(r.score)
    assert all(len(found) == 1 for found in scores.values())     # equal texts, equal scores
    assert len(scores) < len(out)
    assert lm.score(edge_table(spark, []), fold(F.col("doc_id"), 5) != 1).count() == 0


def test_lm_probabilities_sum_to_one():
    """Over all next words at a place, spelt or coded, the branches share the mass exactly."""
    first, length, node, turn = lm.huffman(np.array([5, 3, 9, 1, 1, 40]))
    rng = np.random.default_rng(1)
    p = rng.random(10)
    total = 0.0
    for s in range(6):
        path = slice(first[s], first[s] + length[s])
        total += np.prod([p[n] if t else 1 - p[n] for n, t in zip(node[path], turn[path])])
    assert math.isclose(total, 1.0)
    assert list(length).index(min(length)) == 5


def test_lm_weights_adapt_after_every_decision(monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(lm, "ALONE", 9500)
    sizes = [0, 1, 7, 64, 9000, 20000] + [int(x) for x in rng.integers(0, 300, 40)]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    x = rng.normal(size=(lm.CONTEXTS, bounds[-1])).astype(np.float32)
    gate = rng.integers(0, lm.GATES, bounds[-1]).astype(np.int32)
    turn = (rng.random(bounds[-1]) < 0.8).astype(np.int8)
    weights = rng.normal(size=(lm.GATES, lm.CONTEXTS))
    expect = []
    for a, b in zip(bounds, bounds[1:]):
        own, total = weights.copy(), 0.0
        for i in range(a, b):
            sign = 2 * int(turn[i]) - 1
            here = x[:, i].astype(float)
            margin = sign * float(own[gate[i]] @ here)
            total -= math.log1p(math.exp(-margin))
            own[gate[i]] += lm.RATE * sign * here / (1 + math.exp(margin))
        expect.append(total)
    got = lm.mix_scores(x, gate, turn, bounds, weights)
    assert np.allclose(got, expect, rtol=1e-9, atol=1e-9)
    few = lm.mix_scores(x, gate, turn, bounds[:7], weights)
    assert few.tolist() == got[:6].tolist()
    alone = [lm.mix_scores(x[:, a:b], gate[a:b], turn[a:b], np.array([0, b - a]), weights)[0]
             for a, b in zip(bounds, bounds[1:])]
    assert alone == got.tolist()                    # whatever rows stand beside them


def test_lm_start_weights_fit_all_training_rows(spark):
    rnd = random.Random(12)
    texts = ["the same old line"] * 1200
    texts += [" ".join(f"w{int(rnd.random() ** 2 * 80)}" for _ in range(30)) for _ in range(1500)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    count = Counter(w for t in texts for w in t.split())
    letters = np.zeros(257, np.int64)
    for w, n in count.items():
        letters[:256] += n * np.bincount(list(w.encode()), minlength=256)
        letters[256] += n
    (_, _, chunk), = chunks(pa.array(sorted(count)), lower=True)
    coder = lm.Coder(chunk.word_hashes(), np.array([count[w] for w in sorted(count)]),
                     len(texts), letters)
    tables = lm.count_decisions(rows, spark.sparkContext.broadcast(coder))
    weights = lm.start_weights(rows, spark.sparkContext.broadcast((coder, tables)))
    slope = -10.0 * (weights - lm.START_WEIGHT)
    bend = 10.0 * np.tile(np.eye(lm.CONTEXTS), (lm.GATES, 1, 1))
    kept = []
    for _, _, chunk in chunks(pa.array(texts), lower=True):
        slots, turn, is_byte, _ = coder.decisions(chunk)
        x, gate = (np.float64(v) for v in lm.predictions(tables, slots, turn, is_byte, True))
        gate = gate.astype(int)
        kept.append((x, gate, turn))
        values, gates, turns = lm.cell_values(lm.cells_of(x, gate, turn))
        assert (gates == gate).all() and (turns == turn).all()
        assert np.abs(values.T - np.clip(x, -9, 9)).max() <= lm.WIDTH / 2 + 1e-9
        values = values.T
        p = 1 / (1 + np.exp(-(weights[gate].T * values).sum(axis=0)))
        for g in range(lm.GATES):
            at = values[:, gate == g]
            slope[g] += at @ (turn - p)[gate == g]
            bend[g] += (at * (p * (1 - p))[gate == g]) @ at.T
    assert np.abs(np.linalg.solve(bend, slope[:, :, None])).max() < 1e-5

    def loss(w):
        return sum(np.logaddexp(0, -(2.0 * turn - 1) * (w[gate].T * x).sum(axis=0)).sum()
                   for x, gate, turn in kept)

    # Quantising costs next to nothing: no step in any direction lowers the loss much.
    rng = np.random.default_rng(2)
    best = min(loss(weights + s * rng.normal(size=weights.shape)) for s in (0.01, 0.03, 0.1) for _ in range(20))
    assert loss(weights) < 1.01 * best
    assert loss(weights) < loss(np.full(weights.shape, lm.START_WEIGHT))


def test_lm_learns_from_what_it_has_seen(spark):
    rows = [(i, f"the cat sat on the mat and cat number {i % 7} ran away from the dog", None, None, 0)
            for i in range(300)]
    rows += [(1000, rows[0][1], None, None, 0), (1001, "zq xv kj qq wz pf vx " * 3, None, None, 0)]
    out = {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, SCHEMA),
                                         F.col("doc_id") < 1000).collect()}
    assert out[1000].score > out[1000].base_score and out[1000].bits_per_byte < 0.6
    assert out[1001].bits_per_byte > 3 * out[1000].bits_per_byte


def test_sharding_law_slots_and_moves(spark):
    rnd = random.Random(6)
    rows = edge_rows() + [(100 + i, "x" * rnd.randrange(2000), None, None, 0) for i in range(900)]
    out = sharding.reshard(edge_table(spark, rows)).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    per = {}
    for r in out:
        per.setdefault(r.shard, []).append(r)
    mean = sum(r["size"] for r in out) / 24
    for rs in per.values():   # a shard is above the mean only by one row that is larger itself
        assert sum(r["size"] for r in rs) < 1.05 * mean or max(r["size"] for r in rs) > mean
    for rs in per.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    assert sharding.reshard(edge_table(spark, [])).count() == 0


def test_min_cost_flow_is_optimal():
    rnd = random.Random(7)
    for _ in range(60):
        n, m = rnd.randint(1, 3), rnd.randint(1, 3)
        supply = [rnd.randrange(4) for _ in range(n)]
        demand = [0] * m
        for _ in range(sum(supply)):
            demand[rnd.randrange(m)] += 1
        cost = [[rnd.randrange(5) for _ in range(m)] for _ in range(n)]
        flow = sharding.min_cost_flow(supply, demand, cost)
        units = [i for i, s in enumerate(supply) for _ in range(s)]
        places = [j for j, d in enumerate(demand) for _ in range(d)]
        best = min((sum(cost[i][j] for i, j in zip(units, p))
                    for p in set(itertools.permutations(places))), default=0)
        assert sum(f * cost[i][j] for (i, j), f in flow.items()) == best
        assert [sum(f for (i, _), f in flow.items() if i == k) for k in range(n)] == supply


@pytest.mark.parametrize("old,new", [(4, 2), (3, 7), (4, 4)])
def test_store_keeps_every_row(spark, tmp_path, old, new):
    rows = edge_rows() + [(i, f"text {i % 9} " * (i % 40), "en", "s", i) for i in range(120)]
    rows += [(None, "again", None, None, 1)] * 2 + [(3, "third", None, None, 1)]
    docs = edge_table(spark, rows)
    path = sharding.write_store(docs, str(tmp_path / "store"), old)
    want = Counter(map(str, docs.collect()))
    touched = sharding.reshard_store(spark, path, new)
    back = spark.read.parquet(path)
    assert Counter(map(str, back.select("doc.*").collect())) == want
    shards = {r.shard for r in back.select("shard").distinct().collect()}
    assert shards <= set(range(new)) and set(range(min(old, new), max(old, new))) <= set(touched)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").glob("shard=*/*.parquet")}
    again = sharding.reshard_store(spark, path, new)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").glob("shard=*/*.parquet")}
    untouched = [p for p in before if int(p.parent.name[6:]) not in again]
    assert all(after.get(p) == before[p] for p in untouched)
    assert Counter(map(str, spark.read.parquet(path).select("doc.*").collect())) == want


def test_mixing_targets_and_budgets(spark):
    rows = edge_rows() + [(100 + i, "w " * (i % 50), None, f"s{i % 5}", 0) for i in range(400)]
    out = mixing.mix(edge_table(spark, rows)).collect()
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(words(t))
    names = sorted((s for s in sizes if s is not None)) + [None]
    aims = dict(zip(names, mixing.targets([sizes[s] for s in names],
                                          [(1, 2, 3)[i % 3] for i in range(len(names))])))
    assert math.isclose(sum(aims.values()), sum(sizes.values()))
    taken = Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, aims[r.source])
        assert 0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
    for s in names:
        if s in ("s0", "s1", "s2", "s3", "s4"):
            assert abs(taken[s] - aims[s]) <= 1
    again = mixing.mix(edge_table(spark, rows[::-1])).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))
    assert mixing.mix(edge_table(spark, [])).count() == 0
    assert mixing.sampled_copies(edge_table(spark, [])).count() == 0
    unique = [r for r in rows if r[0] not in (None, 3)]
    copies = mixing.sampled_copies(edge_table(spark, unique))
    assert copies.columns == edge_table(spark, []).columns
    expect = {r.doc_id: r.taken // r["size"] for r in mixing.mix(edge_table(spark, unique)).collect()
              if r.taken}
    assert Counter(r.doc_id for r in copies.collect()) == expect


def test_mixing_copies_of_null_and_repeated_ids(spark):
    rows = edge_rows() + [(None if i % 3 == 0 else i // 2, "w " * (i % 20) + f"x{i % 4}", None,
                           f"s{i % 4}", i) for i in range(300)]
    docs = edge_table(spark, rows)
    taken = Counter()
    for r in mixing.mix(docs).collect():
        if r.taken:
            taken[r.doc_id, r.source, r["size"]] += r.taken // r["size"]
    copies = mixing.sampled_copies(docs).collect()
    assert any(k is None for k, _, _ in taken) and any(k == 3 for k, _, _ in taken)
    assert Counter((r.doc_id, r.source, len(words(r.text))) for r in copies) == taken
    assert max(Counter(map(tuple, copies)).values()) <= 3 * max(Counter(map(tuple, rows)).values())


def test_targets_stop_at_three_times():
    assert mixing.targets([10, 1000], [3, 1]) == [30.0, 980.0]
    assert mixing.targets([0, 5], [1, 2]) == [0.0, 5.0]
    assert mixing.targets([], []) == []


def test_knapsack_is_exact():
    rnd = random.Random(8)
    for _ in range(150):
        lengths = rnd.sample(range(1, 30), rnd.randint(1, 5))
        counts = [rnd.randint(1, 3) for _ in lengths]
        budget = rnd.randint(0, sum(a * b for a, b in zip(lengths, counts)))
        best = max(s for t in itertools.product(*[range(c + 1) for c in counts])
                   if (s := sum(a * b for a, b in zip(lengths, t))) <= budget)
        take = mixing.knapsack(lengths, counts, budget)
        assert sum(a * b for a, b in zip(lengths, take)) == best
        assert all(0 <= a <= b for a, b in zip(take, counts))


def test_toxicity_held_out_and_edges(spark):
    rnd = random.Random(9)
    plain = [f"{a}{b}" for a in ("tion", "er", "an", "th", "in") for b in ("ou", "ea", "st", "nd")]
    rows, labels = [], []
    for i in range(500):
        w = [rnd.choice(plain) for _ in range(rnd.randrange(20, 120))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                w[rnd.randrange(len(w))] = rnd.choice(["idiot", "moron", "worthless"])
        rows.append((1000 + i, " ".join(w), None, None, 0))
        labels.append((1000 + i, int(toxic)))
    marks = spark.createDataFrame(labels + [(None, 1), (5, None), (99999, 0)], "doc_id long, toxic int")
    docs = edge_table(spark, rows + edge_rows())
    held = fold(F.col("doc_id"), 3) == 1
    model = toxicity.train_model(docs, marks, ~held)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows) + len(edge_rows()) and all(0 <= r.score <= 1 for r in out)
    truth = dict(labels)
    unseen = [r for r in out if r.doc_id in truth and held_out(r.doc_id, 3)]
    assert len(unseen) > 100
    right = sum((r.score >= toxicity.THRESHOLD) == bool(truth[r.doc_id]) for r in unseen)
    assert right / len(unseen) > 0.97
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns
    assert left.count() == sum(r.score < toxicity.THRESHOLD for r in out)
    one = toxicity.train_model(docs, marks.filter("toxic = 0"), ~held)
    assert all(r.score < 0.01 for r in toxicity.score(docs, one).collect())
    none = toxicity.train_model(edge_table(spark, []), marks.limit(0), ~held)
    assert toxicity.score(edge_table(spark, []), none).count() == 0
