"""Importance resampling of documents towards a target distribution.

Documents and target texts are described by hashed word n-grams. Two bags of
buckets, one over all documents and one over all target texts, give each bucket
a gain: the floored thousandfold log ratio of its smoothed shares. A document's
weight is the floored mean gain of its n-grams. Adding Gumbel noise seeded by
the document's id and taking the highest sums draws without replacement, with
probabilities proportional to the exponential of the weights.

The n-grams of a batch are found together: the batch's texts are joined with a
separator that no word contains, one regex pass finds every word, the words'
documents come from a binary search in the documents' offsets, and an n-gram
whose first and last words differ in document is masked out before the buckets
are counted. Each task sends one row a bucket; the bags are summed in Spark.
The draw numbers the slim scored rows by their order in range partitions.

Defined cases: a null or empty text, or one without words, has no n-grams and
weight 0; a text of fewer words than ``n`` has its shorter n-grams only; with
no documents or no target texts the gains compare with the smoothing alone;
texts below ``min_words`` words are scored but never drawn; a null id counts as
empty text in the noise; rows of one id are scored and ranked each for itself,
equal sums going to the smaller id, a null id first, then in any order.
Columns besides the two named are ignored by ``draw`` and carried by ``resample``.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightlake.llm.text import chunks
from brightlake.operators.ntile import global_row_number
from brightlake.session import written

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024

#: Fixed by the contract: word characters after lower-casing A-Z.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SEPARATOR = b"\n"


class _Buckets(dict):
    """Bucket of a feature; each distinct one of a batch is hashed once."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def batch_features(data: np.ndarray, offsets: np.ndarray, n: int,
                   buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rows, buckets, words)``: row and bucket of each n-gram, number of words of each row."""
    raw, sizes = data.tobytes(), np.diff(offsets)
    joined = _SEPARATOR.join([raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
    starts, found = [], []
    for m in WORD.finditer(joined.lower()):
        starts.append(m.start())
        found.append(m.group())
    shifted = np.cumsum(sizes + 1)   # where the next text starts, separators counted
    rows = np.searchsorted(shifted, np.array(starts, dtype=np.int64), side="right")
    words = np.bincount(rows, minlength=len(sizes))
    bucket_of = _Buckets(buckets)
    all_rows, all_buckets = [], []
    for k in range(1, n + 1):
        grams = found if k == 1 else [b" ".join(found[i:i + k]) for i in range(len(found) - k + 1)]
        last = len(grams)
        inside = rows[:last] == rows[k - 1:k - 1 + last]
        all_rows.append(rows[:last][inside])
        all_buckets.append(np.fromiter(map(bucket_of.__getitem__, grams), np.int64, last)[inside])
    return np.concatenate(all_rows), np.concatenate(all_buckets), words


def bucket_counts(texts: DataFrame, text: str = "text", n: int = 1,
                  buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``found``: how often each bucket occurs in all texts."""
    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, chunk in chunks(batch.column(0)):
                _, found, _ = batch_features(chunk.data, chunk.offsets, n, buckets)
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "found"])

    return (texts.select(F.col(text).alias("_text")).mapInArrow(run, "bucket long, found long")
            .groupBy("bucket").agg(F.sum("found").alias("found")))


def _bag(texts: DataFrame, text: str, n: int, buckets: int) -> np.ndarray:
    """At most ``buckets`` rows reach the driver, whatever the input."""
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, found in bucket_counts(texts, text, n, buckets).collect():
        out[bucket] = found
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandfold log ratio of the smoothed shares of each bucket."""
    size, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(
        float((t + 1) * (s_all + size)) / float((s + 1) * (t_all + size))))
        for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def _weighed(docs: DataFrame, target: DataFrame, row, key: str, text: str, target_text: str,
             n: int, buckets: int) -> DataFrame:
    """``_row``, ``_key``, ``n_words``, ``n_features``, ``weight`` of every document."""
    gain = gains(_bag(docs, text, n, buckets), _bag(target, target_text, n, buckets))

    def run(batches):
        for batch in batches:
            for first, end, chunk in chunks(batch.column(2)):
                rows, found, words = batch_features(chunk.data, chunk.offsets, n, buckets)
                count = np.bincount(rows, minlength=chunk.n)
                sums = np.zeros(chunk.n, dtype=np.int64)
                np.add.at(sums, rows, gain[found])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(first, end - first) for i in (0, 1)),
                     *(pa.array(x.astype(np.int64))
                       for x in (words, count, sums // np.maximum(count, 1)))],
                    ["_row", "_key", "n_words", "n_features", "weight"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(row.alias("_row"), F.col(key).alias("_key"),
                       F.col(text).alias("_text")).mapInArrow(
        run, f"_row long, _key {kind}, n_words long, n_features long, weight long")


def _drawn(docs: DataFrame, target: DataFrame, row, key: str, text: str, target_text: str = "text",
           n: int = 1, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT,
           seed: int = SEED) -> DataFrame:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_key").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = written(_weighed(docs, target, row, key, text, target_text, n, buckets)
                     .withColumn("score", F.col("weight") + noise), "importance-scores")
    able = F.col("n_words") >= min_words
    ranked = global_row_number(scored.filter(able), [F.desc("score"), F.asc("_key"), F.asc("_row")],
                               "_rn", "_n")
    drawn = F.col("_rn") <= F.floor(F.col("_n") * percent / 100)
    columns = ["_row", "_key", "n_features", "weight", "score"]
    return (ranked.select(*columns, F.when(drawn, F.col("_rn")).cast("long").alias("rank"))
            .unionByName(scored.filter(~able).select(*columns, F.lit(None).cast("long").alias("rank"))))


def draw(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
         **options) -> DataFrame:
    """``key``, ``n_features``, ``weight``, ``score`` and, where drawn, ``rank`` of every document.

    Options: ``n`` words an n-gram at most, ``buckets``, ``min_words`` and ``percent`` of the
    draw, its ``seed``, and ``target_text``, the text column of ``target``.
    """
    return (_drawn(docs, target, F.lit(0).cast("long"), key, text, **options)
            .select(F.col("_key").alias(key), "n_features", "weight", "score", "rank"))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
             **options) -> DataFrame:
    """The documents drawn, with all their columns. Rows are numbered once and joined by number."""
    rows = written(docs.select(F.monotonically_increasing_id().alias("_row"),
                               F.struct(*[docs[c] for c in docs.columns]).alias("_doc")),
                   "importance-rows")
    plain = rows.select("_row", F.col("_doc")[key].alias("_0"), F.col("_doc")[text].alias("_1"))
    chosen = (_drawn(plain, target, F.col("_row"), "_0", "_1", **options)
              .filter("rank IS NOT NULL").select("_row"))
    return rows.join(chosen, "_row", "left_semi").select("_doc.*")
