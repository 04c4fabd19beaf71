"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

A text's features are the distinct character n-grams it holds, hashed to
buckets. The classifier is fitted on a bounded sample of the labelled training
rows (``FIT_ROWS`` a class, those of smallest hash; weighted back to the class
sizes of all): document counts of each bucket in toxic and in other texts are
summed, the ``FEATURES`` buckets that differ most are scaled by their smoothed
log-count ratios, and a logistic regression gives each a weight. The model has
the same size at any scale; every text is scored whole.

Defined cases: a null or empty text has no features and gets the score of the
bias alone; labels that are null or belong to no document are left out; a
document labelled twice counts once for each label row; with one class only,
every score is that of the class; without training rows it is nearly 0. Equal texts get equal scores. Other columns are ignored by ``score``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightlake.llm.text import LOWER, SMALL_BYTES, chunks
from brightlake.session import scratch_path

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
ORDERS = (3, 4, 5)
THRESHOLD = 0.7
#: Labelled rows of each class that the regression is fitted on, at most.
FIT_ROWS = 4000
#: Buckets that get a weight: those whose two shares differ most beyond chance.
FEATURES = 4096
SMOOTHING = 1.0
#: Texts of a chunk, at most: each takes a flag for every weighted bucket.
ROWS = 1024


def _grams(texts: pa.Array):
    """Yield ``(first row, rows, starts, {n: bucket of the n-gram at each place})``."""
    for first, _, chunk in chunks(texts, limit=SMALL_BYTES, rows=ROWS):
        raw = LOWER[chunk.data]
        points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"),
                               np.uint32)
        starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[chunk.offsets]
        hashed, value = {}, np.zeros(len(points) + 1, np.uint32)
        for n in range(1, max(ORDERS) + 1):
            value = value[:-1] * np.uint32(0x01000193)
            value ^= points[n - 1:]
            if n in ORDERS:
                spread = (value ^ (value >> np.uint32(15))) * np.uint32(0x9E3779B1)
                hashed[n] = spread >> np.uint32(32 - BUCKET_BITS)
            if not len(value):
                break
        yield first, chunk.n, starts, hashed


def gram_buckets(texts: pa.Array):
    """Yield ``(row, distinct buckets)`` for every row that has an n-gram, in order."""
    seen = np.zeros(BUCKETS, dtype=bool)
    for first, rows, starts, hashed in _grams(texts):
        for row in range(rows):
            a, b = starts[row], starts[row + 1]
            if b - a < min(ORDERS):
                continue
            for n, value in hashed.items():
                if b - a >= n:
                    seen[value[a:b - n + 1]] = True
            found = np.flatnonzero(seen)
            seen[found] = False
            yield first + row, found


@dataclass(frozen=True)
class Model:
    """``buckets`` (ascending), their weights, and the bias."""
    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        place = np.full(BUCKETS, -1, dtype=np.int16)
        place[self.buckets] = np.arange(len(self.buckets))
        margin = np.full(len(texts), self.bias)
        width = max(len(self.buckets), 1)
        for first, rows, starts, hashed in _grams(texts):
            held = np.zeros(rows * width, dtype=bool)
            for n, value in hashed.items():
                at = place[value]
                where = np.flatnonzero(at >= 0)
                row = np.searchsorted(starts, where, side="right") - 1
                inside = where + n <= starts[row + 1]
                held[row[inside] * width + at[where[inside]]] = True
            if len(self.buckets):
                on = np.flatnonzero(held)
                margin[first:first + rows] += np.bincount(on // width, self.weights[on % width], rows)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def ratios(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Smoothed log ratio of a bucket's share in toxic and in other texts."""
    p = (toxic + SMOOTHING) / (n_toxic + 2 * SMOOTHING)
    q = (clean + SMOOTHING) / (n_clean + 2 * SMOOTHING)
    return np.log(p / q)


def choose(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Buckets whose shares differ most, in standard errors of the difference."""
    p, q = toxic / n_toxic, clean / n_clean
    both = (toxic + clean) / (n_toxic + n_clean)
    error = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_toxic + 1 / n_clean))
    z = np.abs(p - q) / error
    z[toxic + clean < 3] = 0
    order = np.argsort(-z, kind="stable")[:FEATURES]
    return np.sort(order[z[order] > 0])


def fit(rows: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, scale: np.ndarray,
        penalty: float = 1e-3, rounds: int = 8, inner: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse 0/1 rows scaled by ``scale`` (Newton steps by
    conjugate gradients). Returns weights of the unscaled 0/1 features and the bias."""
    at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    value, n = scale[at], len(scale)
    weight = weight / weight.sum()
    ridge = np.append(np.full(n, penalty), 1e-6)

    def forward(w):
        return np.bincount(owner, value * w[at], len(rows)) + w[n]

    def back(g):
        return np.append(np.bincount(at, value * g[owner], n), g.sum())

    def loss(w, margin):
        return weight @ (np.logaddexp(0, margin) - labels * margin) + ridge @ (w * w) / 2

    w = np.zeros(n + 1)
    margin = forward(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        slope = back(weight * (p - labels)) + ridge * w
        curve = weight * np.maximum(p * (1 - p), 1e-6)
        step, rest = np.zeros(n + 1), -slope
        way, size = rest.copy(), rest @ rest
        for _ in range(inner):
            if size < 1e-16:
                break
            bent = back(curve * forward(way)) + ridge * way
            length = size / max(way @ bent, 1e-300)
            step += length * way
            rest -= length * bent
            size, before = rest @ rest, size
            way = rest + size / before * way
        now, move, t = loss(w, margin), forward(step), 1.0
        while t > 1e-4 and loss(w + t * step, margin + t * move) > now:
            t /= 2
        w, margin = w + t * step, margin + t * move
    return w[:n] * scale, float(w[n])


def fit_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
               train: Column) -> tuple[DataFrame, dict[int, int]]:
    """Texts of the training rows of smallest hash in each class, and the class sizes.

    At most ``FIT_ROWS`` ids a class are broadcast; the texts go to the shared
    scratch folder, so that a lost executor costs a re-read and no new scan.
    """
    usable = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & train)
    totals = {int(r[0]): r[1] for r in usable.groupBy(label).count().collect()}
    picks = [usable.filter(F.col(label) == c).select(key, F.col(label).cast("int").alias("_label"))
             .orderBy(F.xxhash64(key), key).limit(FIT_ROWS) for c in (0, 1)]
    sample = docs.select(key, text).join(F.broadcast(picks[0].unionAll(picks[1])), key)
    path = scratch_path(docs.sparkSession, "toxicity-sample")
    sample.write.parquet(path)
    return docs.sparkSession.read.parquet(path), totals


def train_model(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id",
                text: str = "text", label: str = "toxic") -> Model:
    """Fit on the rows of ``labels`` that ``train`` (a condition on them) allows."""
    sample, totals = fit_sample(docs, labels, key, text, label, train)
    none = np.zeros(0, np.int64), np.zeros(0)
    drawn = {r[0]: r[1] for r in sample.groupBy("_label").count().collect()}
    if len(drawn) < 2:
        share = float(1 in drawn)
        return Model(*none, 30.0 if share else -30.0)

    def count(batches):
        held = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            kinds = batch.column(1).to_numpy()
            for row, found in gram_buckets(batch.column(0)):
                held[kinds[row], found] += 1
        at = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_pydict({"bucket": at.astype(np.int32), "clean": held[0, at],
                                          "toxic": held[1, at]})

    counted = (sample.select(text, "_label").mapInArrow(count, "bucket int, clean long, toxic long")
               .groupBy("bucket").agg(F.sum("clean"), F.sum("toxic")).toPandas())
    clean, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    clean[counted.iloc[:, 0]], toxic[counted.iloc[:, 0]] = counted.iloc[:, 1], counted.iloc[:, 2]
    chosen = choose(toxic, clean, drawn[1], drawn[0])
    scale = ratios(toxic, clean, drawn[1], drawn[0])[chosen]

    def features(batches):
        place = np.full(BUCKETS, -1, dtype=np.int16)
        place[chosen] = np.arange(len(chosen))
        for batch in batches:
            held = [b""] * batch.num_rows
            for row, found in gram_buckets(batch.column(0)):
                held[row] = place[found][place[found] >= 0].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2),
                                              pa.array(held, pa.binary())],
                                             ["label", "rank", "held"])

    def fit_all(batches):
        parts = [b.to_pandas() for b in batches]
        if not sum(map(len, parts)):
            return
        rows = pd.concat(parts).sort_values(["rank", "label"])
        marks = rows["label"].to_numpy()
        each = np.array([totals[c] / drawn[c] for c in (0, 1)])
        weights, bias = fit([np.frombuffer(h, np.int16).astype(np.int64) for h in rows["held"]],
                            marks, each[marks], scale)
        yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()], "bias": [bias]})

    model = (sample.select(text, "_label", F.xxhash64(key, text).alias("_rank"))
             .mapInArrow(features, "label int, rank long, held binary")
             .repartition(1).mapInArrow(fit_all, "weights binary, bias double").collect()[0])
    return Model(chosen, np.frombuffer(bytes(model["weights"])), model["bias"])


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the score of every whole text."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(batch.column(1)))], [key, "score"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double")


def drop_toxic(docs: DataFrame, model: Model, text: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns."""
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at)) < threshold))

    return docs.mapInArrow(run, docs.schema)
