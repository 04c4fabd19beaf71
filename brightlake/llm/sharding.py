"""Resharding by minimum-cost flow: near-equal bytes with the fewest bytes moved.

Old shard sizes are the supplies and new capacities the demands of a flow in
which staying costs nothing and moving a byte costs one. The flow says how
many bytes each old shard hands to each new one. Rows lie in each old shard in
blocks, in a seeded order; a block goes whole to one new shard unless a cut of
the flow falls inside it, where its rows are split. Rows too large to fit the
cut (``total / (new shards * LARGE_PARTS)`` bytes; there are fewer than
``new shards * LARGE_PARTS``) are placed one by one beforehand. Only shards
that give or receive rows are rewritten.

Defined cases: a null or empty text has its fixed bytes only; a null id is an
id like any other; repeated rows are placed each, in any order among equals;
an empty table gives no rows. Other columns are ignored by ``reshard`` and kept
by ``reshard_store``, which moves every row of a written store exactly once.
"""

from __future__ import annotations

import re
from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightlake.session import scratch_path, written
from brightlake.sources.files import file_name, read_files, recover, replace_files, table_files

OLD_SHARDS = 16
NEW_SHARDS = 24
ROW_BYTES = 8
#: Rows of an old shard in one block, about.
BLOCK_ROWS = 32768
LARGE_PARTS = 200


def min_cost_flow(supply: list[int], demand: list[int],
                  cost: list[list[int]]) -> dict[tuple[int, int], int]:
    """Cheapest flow from supplies to demands of equal sum, by cheapest augmenting paths."""
    n, m = len(supply), len(demand)
    source, sink = n + m, n + m + 1
    room: dict[tuple[int, int], int] = {}
    price: dict[tuple[int, int], int] = {}
    out: list[set[int]] = [set() for _ in range(n + m + 2)]

    def edge(a, b, most, c):
        room[a, b], room[b, a], price[a, b], price[b, a] = most, 0, c, -c
        out[a].add(b)
        out[b].add(a)

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
        for j in range(m):
            edge(i, n + j, s, cost[i][j])
    for j, d in enumerate(demand):
        edge(n + j, sink, d, 0)
    while True:
        best, came, queue, queued = {source: 0}, {}, deque([source]), {source}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for b in sorted(out[a]):
                if room[a, b] > 0 and best[a] + price[a, b] < best.get(b, 1 << 62):
                    best[b], came[b] = best[a] + price[a, b], a
                    if b not in queued:
                        queue.append(b)
                        queued.add(b)
        if sink not in came:
            break
        path, b = [], sink
        while b != source:
            path.append((came[b], b))
            b = came[b]
        push = min(room[e] for e in path)
        for a, b in path:
            room[a, b] -= push
            room[b, a] += push
    return {(i, j): room[n + j, i] for i in range(n) for j in range(m) if room[n + j, i] > 0}


def place_large(large: list[tuple[int, int]], capacity: list[int]) -> tuple[list[int], list[int]]:
    """A new shard for each ``(old shard, bytes)`` by falling size, and the room that is left."""
    room, placed = list(capacity), [0] * len(large)
    for k in sorted(range(len(large)), key=lambda k: (-large[k][1], k)):
        old, size = large[k]
        at = old if old < len(room) and room[old] >= size else max(
            range(len(room)), key=lambda j: (room[j], -j))
        placed[k] = at
        room[at] -= size
    return placed, room


def plan(old_bytes: dict[int, int], large: list[tuple[int, int]], old_shards: int,
         new_shards: int) -> tuple[list[int], dict[tuple[int, int], int]]:
    """New shards of the large rows, and the bytes of small rows between shards."""
    whole = sum(old_bytes.values()) + sum(s for _, s in large)
    capacity = [whole * (j + 1) // new_shards - whole * j // new_shards
                for j in range(new_shards)]
    placed, room = place_large(large, capacity)
    over = -sum(min(r, 0) for r in room)
    room = [max(r, 0) for r in room]
    for j in sorted(range(new_shards), key=lambda j: room[j]):
        cut = min(over, room[j])
        room[j] -= cut
        over -= cut
    supply = [old_bytes.get(i, 0) for i in range(old_shards)]
    cost = [[int(i != j) for j in range(new_shards)] for i in range(old_shards)]
    return placed, min_cost_flow(supply, room, cost)


def reshard(docs: DataFrame, key: str = "doc_id", text: str = "text",
            old_shards: int = OLD_SHARDS, new_shards: int = NEW_SHARDS) -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``old_shard``, ``shard`` and ``slot`` of every row."""
    return _reshard(docs, key, text, F.pmod(F.xxhash64(key), F.lit(old_shards)).cast("int"),
                    old_shards, new_shards)


def _reshard(docs: DataFrame, key: str, text: str, old_shard: Column, old_shards: int,
             new_shards: int, row: tuple[str, ...] = ()) -> DataFrame:
    """``reshard`` from the column ``old_shard``; the columns ``row`` tell rows apart."""
    spark = docs.sparkSession
    path = scratch_path(spark, "sharding-rows")
    (docs.select(*row, F.col(key),
                 (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
                 F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
                 old_shard.alias("old_shard"))
     .withColumn("_order", F.xxhash64(F.lit(11), key, "size", "text_crc32"))
     .write.parquet(path))
    rows = spark.read.parquet(path)
    whole = rows.agg(F.sum("size")).first()[0] or 0
    rows = rows.withColumn("_large", F.col("size") > F.lit(whole // (new_shards * LARGE_PARTS)))
    # Fewer than new_shards * LARGE_PARTS rows can be that large.
    large_rows = (rows.filter("_large").select("old_shard", "size", "_order")
                  .orderBy("size", "_order").collect())
    sums = {r["old_shard"]: r for r in rows.filter("not _large").groupBy("old_shard")
            .agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}
    placed, flow = plan({i: r["b"] for i, r in sums.items()},
                        [(r["old_shard"], r["size"]) for r in large_rows], old_shards, new_shards)

    # Blocks of each old shard, and where each begins in the shard's bytes.
    blocks = F.create_map(*[F.lit(x) for i in range(old_shards)
                            for x in (i, -(-sums[i]["n"] // BLOCK_ROWS) if i in sums else 1)])
    part = F.pmod(F.col("_order"), blocks[F.col("old_shard")]).cast("int")
    small = rows.filter("not _large").withColumn("_block", part)
    begin = (small.groupBy("old_shard", "_block").agg(F.sum("size").alias("_bytes"))
             .withColumn("_begin", F.sum("_bytes").over(
                 Window.partitionBy("old_shard").orderBy("_block")) - F.col("_bytes"))
             .drop("_bytes"))
    inside = Window.partitionBy("old_shard", "_block").orderBy("_order", key, *row)
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    small = (small.join(begin, ["old_shard", "_block"])
             .withColumn("_middle", F.col("_begin") + upto - F.col("size") / 2))
    cuts, from_old = [], dict.fromkeys(range(old_shards), 0)
    for i, j in sorted(flow, key=lambda e: (e[0], e[0] != e[1], e[1])):
        cuts.append((i, float(from_old[i]), float(from_old[i] + flow[i, j]), j))
        from_old[i] += flow[i, j]
    cuts = spark.createDataFrame(cuts, "old_shard int, _low double, _high double, shard int")
    small = (small.join(F.broadcast(cuts), "old_shard")  # at most old_shards * new_shards rows
             .filter("_middle >= _low and _middle < _high"))
    columns = [*row, key, "size", "text_crc32", "old_shard", "shard", "_block", "_order"]
    # Equal large rows of one shard share a rank; they go to the places of that rank in turn.
    spots = spark.createDataFrame([(r["old_shard"], r["size"], r["_order"], k, j) for k, (r, j) in
                                   enumerate(zip(large_rows, placed))],
                                  "old_shard int, size long, _order long, _k int, shard int")
    same = Window.partitionBy("old_shard", "size", "_order").orderBy("_k")
    spots = spots.withColumn("_turn", F.row_number().over(same)).drop("_k")
    turn = Window.partitionBy("old_shard", "size", "_order").orderBy(key, *row)
    large = (rows.filter("_large").withColumn("_turn", F.row_number().over(turn))
             .withColumn("_block", F.lit(-1))
             .join(F.broadcast(spots), ["old_shard", "size", "_order", "_turn"]))
    out = small.select(*columns).unionByName(large.select(*columns))

    # Slots: rows before the block in its new shard, then the place inside the block.
    group = ["shard", "old_shard", "_block"]
    before = (out.groupBy(*group).agg(F.count("*").alias("_rows"))
              .withColumn("_before", F.sum("_rows").over(
                  Window.partitionBy("shard").orderBy("old_shard", "_block")) - F.col("_rows"))
              .drop("_rows"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy("_order", key, *row))
    return (out.join(before, group).withColumn("slot", F.col("_before") + place - 1)
            .select(*row, key, "size", "text_crc32", "old_shard", "shard", "slot"))


def write_store(docs: DataFrame, path: str, shards: int = OLD_SHARDS, key: str = "doc_id") -> str:
    """A new store: rows whole in ``doc``, in folders by ``shard`` (dealt by id)."""
    (docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
                 F.pmod(F.xxhash64(docs[key]), F.lit(shards)).cast("int").alias("shard"))
     .hint("rebalance", "shard").write.partitionBy("shard").parquet(path))
    return path


def reshard_store(spark: SparkSession, path: str, new_shards: int = NEW_SHARDS, key: str = "doc_id",
                  text: str = "text") -> list[int]:
    """Carry the flow out on a written store; returns the shards that gave or received rows.

    Rows are told apart by file and place in the file, so null and repeated ids are rows like
    any other. Only files of affected shards are rewritten, in slot order; a shard that is left
    without rows has no file any more. The replacement is carried on after a crash.
    """
    recover(spark, path)
    row = ("_file", "_at")
    store = spark.read.parquet(path)
    old_shards = (store.agg(F.max("shard")).first()[0] or 0) + 1
    rows = store.select(file_name().alias("_file"), F.col("_metadata.row_index").alias("_at"),
                        F.col("doc")[key].alias("_key"), F.col("doc")[text].alias("_text"), "shard")
    placed = written(_reshard(rows, "_key", "_text", F.col("shard"), old_shards, new_shards, row)
                     .select(*row, "old_shard", "shard", "slot"), "resharded")
    moved = placed.filter(F.col("shard") != F.col("old_shard"))
    touched = {r[0] for r in moved.select(F.explode(F.array("shard", "old_shard"))).distinct().collect()}
    old = [f for f in table_files(spark, path) if int(re.search(r"/shard=(\d+)/", f)[1]) in touched]
    if old:
        docs = read_files(spark, path, old).select(
            "doc", file_name().alias("_file"), F.col("_metadata.row_index").alias("_at"))
        new = (docs.join(placed, list(row)).repartitionByRange("shard", "slot")
               .sortWithinPartitions("shard", "slot").select("doc", "shard"))
        replace_files(new, path, old, ["shard"])
    return sorted(touched)
