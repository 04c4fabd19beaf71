"""Index of the keys that a stream has seen (T1): hash buckets with Bloom filters.

``path/keys/_bucket=<b>/_batch=<i>`` holds the keys of one bucket that batch ``i`` was the
first to bring; ``path/filters/_bucket=<b>/_batch=<i>/_words=<w>`` holds its Bloom filter of
``w`` 64-bit words as rows ``(word, bits)``. A key sets ``KEY_BITS`` bits of one word, so a
probe is one equi-join with the filters of the batch's own buckets. Only the key folders
whose filter lets a key of the batch pass are opened; a batch of new keys opens next to none.

What a batch writes is its own partition (overwritten on a re-run), keys before filters:
keys without a filter, left by a batch that failed in between, are opened always. The
driver handles folder names only, one a key file. ``merge_batches`` folds old batches into
one, so that the number of files follows the number of keys.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightlake.session import delete_path, glob_paths, path_exists, written

#: Keys of a bucket, about, in the first batch; it fixes the number of buckets.
BUCKET_KEYS = 1_000_000
MAX_BUCKETS = 4096
#: Filter bits a key, and bits that a key sets: about 0.3 % of other keys pass.
FILTER_BITS, KEY_BITS = 20, 5
_FILTER_SCHEMA = "word long, bits long, _bucket int, _batch long, _words long"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _word(key: str, words) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), F.col(key)), words)


def _mask(key: str) -> Column:
    h = F.xxhash64(F.lit(2), F.col(key))
    mask = F.lit(0).cast("long")
    for i in range(KEY_BITS):
        at = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return mask


class SeenKeys:
    """The keys of column ``key`` that earlier batches have brought, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int | None = None):
        self.spark, self.key = spark, key
        self.root = path.rstrip("/")
        self.keys, self.filters = f"{self.root}/keys", f"{self.root}/filters"
        self.wanted = buckets

    def key_folders(self) -> dict[tuple[int, int], str]:
        """``(bucket, batch)`` of every key folder, by the listing alone."""
        found = {}
        for path in glob_paths(self.spark, f"{self.keys}/_bucket=*/_batch=*"):
            m = re.search(r"_bucket=(\d+)/_batch=(-?\d+)$", path)
            found[int(m[1]), int(m[2])] = path
        return found

    def filter_folders(self) -> dict[tuple[int, int], tuple[int, str]]:
        found = {}
        for path in glob_paths(self.spark, f"{self.filters}/_bucket=*/_batch=*/_words=*"):
            m = re.search(r"_bucket=(\d+)/_batch=(-?\d+)/_words=(\d+)$", path)
            found[int(m[1]), int(m[2])] = int(m[3]), path
        return found

    def buckets(self, n: int | None = None) -> int:
        """Number of buckets, fixed by the first batch (a folder's name keeps it)."""
        known = glob_paths(self.spark, f"{self.root}/buckets=*")
        if known:
            return int(known[0].rsplit("=", 1)[1])
        if n is None:
            return 0
        count = self.wanted or min(MAX_BUCKETS, 1 << max(0, -(-n // BUCKET_KEYS) - 1).bit_length())
        self.spark.range(0).write.parquet(f"{self.root}/buckets={count}")
        return count

    def folders_to_open(self, batch: DataFrame, batch_id: int) -> list[str]:
        """Folders of other batches that may hold a key of ``batch``."""
        buckets = self.buckets()
        folders = {k: p for k, p in self.key_folders().items() if k[1] != batch_id}
        if not folders:
            return []
        ids = batch.select(self.key).distinct().withColumn("_bucket", _bucket(self.key, buckets))
        touched = {r[0] for r in ids.select("_bucket").distinct().collect()}   # at most MAX_BUCKETS
        folders = {k: p for k, p in folders.items() if k[0] in touched}
        filters = {k: f for k, f in self.filter_folders().items() if k in folders}
        hits = set(folders) - set(filters)
        if filters:
            # An Arrow table is a local relation: no Python worker starts for a few numbers.
            files = self.spark.createDataFrame(pa.table({
                "_bucket": pa.array([b for b, _ in filters], pa.int32()),
                "_batch": pa.array([i for _, i in filters], pa.int64()),
                "_words": pa.array([w for w, _ in filters.values()], pa.int64())}))
            bits = (self.spark.read.schema(_FILTER_SCHEMA).option("basePath", self.filters)
                    .parquet(*[p for _, p in filters.values()]))
            probe = (ids.join(files, "_bucket").withColumn("word", _word(self.key, F.col("_words")))
                     .withColumn("_mask", _mask(self.key)))
            passed = (probe.join(bits.drop("_words"), ["_bucket", "_batch", "word"])
                      .filter(F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask"))
                      .select("_bucket", "_batch").distinct())
            hits |= {(r[0], r[1]) for r in passed.collect()}
        return [folders[k] for k in sorted(hits)]

    def unseen(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Rows of ``batch`` whose key no other batch has brought."""
        folders = self.folders_to_open(batch, batch_id)
        if not folders:
            return batch
        seen = self.read(batch, folders)
        return batch.join(seen, self.key, "left_anti")

    def read(self, like: DataFrame, folders: list[str]) -> DataFrame:
        kind = like.schema[self.key].dataType.simpleString()
        if not folders:
            return self.spark.range(0).select(F.lit(None).cast(kind).alias(self.key))
        return self.spark.read.schema(f"`{self.key}` {kind}").parquet(*folders)

    def own(self, like: DataFrame, batch_id: int) -> DataFrame:
        """The keys that batch ``batch_id`` was the first to bring."""
        return self.read(like, [p for (_, i), p in self.key_folders().items() if i == batch_id])

    def remember(self, fresh: DataFrame, batch_id: int) -> None:
        """Write the batch's new keys (distinct) and their filters."""
        ids = fresh.select(self.key)
        buckets = self.buckets() or self.buckets(ids.count())
        (ids.withColumn("_bucket", _bucket(self.key, buckets))
         .withColumn("_batch", F.lit(batch_id).cast("long")).hint("rebalance", "_bucket")
         .sortWithinPartitions("_bucket", self.key)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_bucket", "_batch").parquet(self.keys))
        # A re-run may size its filter otherwise: the old one goes first.
        for (_, i), (_, path) in self.filter_folders().items():
            if i == batch_id:
                delete_path(self.spark, path)
        self._write_filters(self.own(fresh, batch_id), buckets, batch_id)

    def _write_filters(self, ids: DataFrame, buckets: int, batch_id: int) -> None:
        keyed = ids.withColumn("_bucket", _bucket(self.key, buckets))
        sizes = keyed.groupBy("_bucket").agg(
            F.greatest(F.ceil(F.count(F.lit(1)) * FILTER_BITS / 64), F.lit(1)).cast("long").alias("_words"))
        rows = (keyed.join(sizes, "_bucket").withColumn("word", _word(self.key, F.col("_words")))
                .groupBy("_bucket", "_words", "word").agg(F.bit_or(_mask(self.key)).alias("bits"))
                .withColumn("_batch", F.lit(batch_id).cast("long")))
        (rows.hint("rebalance", "_bucket").sortWithinPartitions("_bucket", "word").write.mode("append")
         .partitionBy("_bucket", "_batch", "_words").parquet(self.filters))

    def merge_batches(self, before: int) -> int:
        """Fold the batches below ``before`` into the newest of them; returns their number.

        For batches that the stream's checkpoint has left behind: they are not run again.
        The merged partition is written before the old ones go; keys that stand twice in
        between are the same set.
        """
        old = {k: p for k, p in self.key_folders().items() if k[1] < before}
        batches = sorted({i for _, i in old})
        if len(batches) < 2:
            return len(batches)
        last = batches[-1]
        all_keys = written(self.spark.read.parquet(*old.values()).distinct(), "merged-keys")
        stale = [p for (_, i), p in old.items() if i != last]
        stale_filters = [p for (_, i), (_, p) in self.filter_folders().items() if i in batches and i != last]
        self.remember(all_keys, last)
        for path in stale_filters + stale:
            delete_path(self.spark, path)
        return len(batches)


def key_table_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/keys")
