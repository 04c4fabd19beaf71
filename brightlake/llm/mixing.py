"""Mixing sources to target weights by subset-sum budget fitting.

Every source has a budget in words. Whole passes over the source fill it as
far as they go (``MAX_PASSES`` at most). For the rest, documents are counted by
exact length: each length gives its share, rounded down, one more copy of
lengths that fit follows while over ``KNAPSACK_WORDS`` words are left, and a
bounded knapsack over the lengths left fills the remainder as exactly as can be. Documents are then drawn by
a seeded hash of id and text inside each length, so reruns agree.

Defined cases: a null or empty text has size 0, and nothing of it is taken; a
null source is a source of its own, last in order; every row is a document of
its own, also with a null or repeated id (equal ids and texts are drawn in any
order); a table without words has targets of 0. Other columns are ignored by
``mix`` and carried along by ``sampled_copies``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightlake.llm.text import WORD_PATTERN
from brightlake.session import scratch_path

WEIGHTS = (1, 2, 3)
MAX_PASSES = 3
SEED = 17
#: Words that the knapsack alone fills (or the longest document, if that is more).
KNAPSACK_WORDS = 1 << 16
#: Documents of one source and length that are ranked together, about.
RANK_ROWS = 4096


def targets(sizes: list[int], weights: list[float], most: int = MAX_PASSES) -> list[float]:
    """Shares of the total by weight; none above ``most`` times its own size."""
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        whole = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / whole > most * sizes[i]}
        if not over:
            for i in free:
                out[i] = left * weights[i] / whole
            break
        for i in sorted(over):
            out[i] = float(most * sizes[i])
            left -= out[i]
        free -= over
    return out


def knapsack(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length to take so that the sum is as near below ``budget`` as can be.

    Sums that can be reached are the set bits of one integer; each length adds
    its count in powers of two.
    """
    reach, steps, full = 1, [], (1 << (budget + 1)) - 1
    for i, (length, count) in enumerate(zip(lengths, counts)):
        left, part = min(count, budget // length if length else 0), 1
        while left > 0:
            n = min(part, left)
            steps.append((i, n, reach))
            reach |= (reach << (n * length)) & full
            left, part = left - n, part * 2
        if reach >> budget & 1:
            break
    at, taken = reach.bit_length() - 1, [0] * len(lengths)
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += n
            at -= n * lengths[i]
    return taken


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> list[int]:
    """Copies to draw of each length (no more than its count) for a word budget."""
    order = sorted(range(len(lengths)), key=lambda i: -int(lengths[i]))
    size = [int(lengths[i]) for i in order]
    have = [int(counts[i]) for i in order]
    total = sum(s * n for s, n in zip(size, have))
    take = [n * budget // total if total else 0 for n in have]
    rest = budget - sum(s * n for s, n in zip(size, take))
    for i, s in enumerate(size):
        if rest > KNAPSACK_WORDS and 0 < s <= rest and take[i] < have[i]:
            take[i] += 1
            rest -= s
    small = [i for i, s in enumerate(size) if 0 < s <= rest and take[i] < have[i]]
    for i, n in zip(small, knapsack([size[i] for i in small],
                                    [have[i] - take[i] for i in small], rest)):
        take[i] += n
    out = [0] * len(lengths)
    for i, n in zip(order, take):
        out[i] = n
    return out


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, seed: int = SEED) -> DataFrame:
    """``key``, source, ``size``, ``source_size``, ``target`` and ``taken`` of every document."""
    return _mixed(docs, F.lit(0), key, text, source, weights, seed).drop("_row")


def _mixed(docs: DataFrame, row: Column, key: str, text: str, source: str, weights=WEIGHTS,
           seed: int = SEED) -> DataFrame:
    """``mix`` with ``row`` as the column ``_row``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "mixing-sizes")
    (docs.select(row.alias("_row"), F.col(key).alias("_key"), F.col(source).alias("_source"),
                 F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0))
                 .cast("long").alias("size"), F.xxhash64(text).alias("_text"))
     .write.parquet(path))
    sized = spark.read.parquet(path)
    totals = sized.groupBy("_source").agg(F.sum("size").alias("s")).collect()
    totals.sort(key=lambda r: (r["_source"] is None, (r["_source"] or "").encode()))
    sizes = [r["s"] for r in totals]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))])
    plan = []
    for i, (row, aim) in enumerate(zip(totals, aims)):
        words = round(aim)
        passes = min(words // sizes[i], MAX_PASSES) if sizes[i] else 0
        plan.append((row["_source"], i, sizes[i], float(aim), passes,
                     words - passes * sizes[i] if passes < MAX_PASSES else 0))
    goals = spark.createDataFrame(
        plan, "_source string, _n int, source_size long, target double, _passes int, _budget long")
    rows = (sized.withColumn("_source", F.col("_source").cast("string")).alias("d")
            .join(goals.alias("g"), F.col("d._source").eqNullSafe(F.col("g._source")))
            .select("_row", "_key", "d._source", "size", "_n", "source_size", "target", "_passes",
                    "_budget", F.xxhash64(F.lit(seed), "_key", "size", "_text").alias("_draw")))

    def fill(lengths: pd.DataFrame) -> pd.DataFrame:
        lengths["_take"] = fit_budget(lengths["size"].to_numpy(), lengths["_rows"].to_numpy(),
                                      int(lengths["_budget"].iloc[0]))
        return lengths[["_n", "size", "_rows", "_take"]]

    drawn = (rows.groupBy("_n", "size").agg(F.count("*").alias("_rows"),
                                            F.first("_budget").alias("_budget"))
             .groupBy("_n").applyInPandas(fill, "_n int, size long, _rows long, _take long"))
    place = (F.shiftrightunsigned("_draw", 1) / F.lit(float(1 << 63))
             * F.ceil(F.col("_rows") / F.lit(RANK_ROWS))).cast("long")
    # Dealt by place, so that a length with a third of all rows is ranked in many tasks.
    rows = (rows.join(drawn, ["_n", "size"]).withColumn("_place", place)
            .repartition("_n", "size", "_place"))
    before = (rows.groupBy("_n", "size", "_place").agg(F.count("*").alias("_here"))
              .withColumn("_before", F.sum("_here").over(
                  Window.partitionBy("_n", "size").orderBy("_place")) - F.col("_here"))
              .drop("_here"))
    rank = F.row_number().over(Window.partitionBy("_n", "size", "_place")
                               .orderBy("_draw", "_key", "_row"))
    return (rows.join(before, ["_n", "size", "_place"])
            .withColumn("_copies", F.col("_passes") + (rank + F.col("_before") <= F.col("_take"))
                        .cast("int"))
            .select("_row", F.col("_key").alias(key), F.col("_source").alias(source), "size",
                    "source_size", "target", (F.col("size") * F.col("_copies")).alias("taken")))


def sampled_copies(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   source: str = "source", **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns.

    Rows are numbered once, and copies are joined back by that number.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "mixing-rows")
    (docs.select(F.monotonically_increasing_id().alias("_row"),
                 F.struct(*[docs[c] for c in docs.columns]).alias("_doc")).write.parquet(path))
    rows = spark.read.parquet(path)
    plain = rows.select("_row", *[F.col("_doc")[c].alias(f"_{n}")
                                  for n, c in enumerate((key, text, source))])
    times = (_mixed(plain, F.col("_row"), "_0", "_1", "_2", **options).filter("taken > 0")
             .select("_row", F.explode(F.sequence(
                 F.lit(1), (F.col("taken") / F.col("size")).cast("int"))).alias("_copy")))
    return rows.join(times, "_row").select("_doc.*")
