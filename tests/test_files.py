"""Replacing some files of a table: upsert, compaction, retention, lookups."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from brightlake.operators.upsert import upsert, upsert_files
from brightlake.plans import ops
from brightlake.sources import files, sinks


def stamps(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
            for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def rows(df):
    return sorted(map(str, df.collect()))


def test_upsert_rewrites_only_files_with_source_keys(spark, scratch):
    path = f"{scratch}/t"
    base = spark.range(1000).selectExpr("id AS k", "id % 3 AS part", "id * 2 AS v", "'old' AS name")
    for i in range(4):
        base.filter(F.col("k").between(250 * i, 250 * i + 249)).coalesce(1).write.mode("append") \
            .partitionBy("part").parquet(path)
    before = stamps(path)
    source = spark.createDataFrame([(3, 0, -1, "new"), (6, 0, -2, "new"), (6, 0, -3, "zzz"),
                                    (2000, 1, 7, "in"), (None, 2, 8, "null")],
                                   "k long, part long, v long, name string")
    want = rows(upsert(spark.read.parquet(path).select(*base.columns), source, ["k"], ["v"], ["v"]))
    out = upsert_files(spark, path, source, ["k"], ["v"], ["v"], ["part"])
    assert out == {"files": len(before), "rewritten": 1}
    after = stamps(path)
    assert sum(p in after and after[p] == t for p, t in before.items()) == len(before) - 1
    assert rows(spark.read.parquet(path).select(*base.columns)) == want
    upsert_files(spark, path, source.filter("k < 9"), ["k"], ["v"], ["v"], ["part"])
    assert rows(spark.read.parquet(path).select(*base.columns)) == want


def test_upsert_files_creates_and_inserts(spark, scratch):
    path = f"{scratch}/t"
    one = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    upsert_files(spark, path, one, ["k"], source_order=["v"])
    assert rows(spark.read.parquet(path)) == ["Row(k=1, v='b')"]
    before = stamps(path)
    assert upsert_files(spark, path, spark.createDataFrame([(2, "c")], "k long, v string"), ["k"])["rewritten"] == 0
    assert before.items() <= stamps(path).items()
    assert spark.read.parquet(path).count() == 2


def test_compaction_packs_small_files_only(spark, scratch):
    path = f"{scratch}/t"
    big = spark.range(200000).selectExpr("id", "md5(string(id)) AS x", "date'2026-01-01' AS `day x`")
    big.coalesce(1).write.partitionBy("day x").parquet(path)
    large = stamps(path)
    for i in range(6):
        small = spark.range(10 * i, 10 * i + 10).selectExpr("-id AS id", "'s' AS x",
                                                            f"date'2026-01-0{1 + i % 2}' AS `day x`")
        small.coalesce(1).write.mode("append").partitionBy("day x").parquet(path)
    want = rows(spark.read.parquet(path))
    size = max(os.path.getsize(p) for p in large)
    out = sinks.compact_small_files(spark, path, target_bytes=size, sort_cols=["id"])
    assert out == {"before": 7, "after": 3}
    after = stamps(path)
    assert len(after) == 3 and large.items() <= after.items()
    assert rows(spark.read.parquet(path)) == want
    assert sinks.compact_small_files(spark, path, target_bytes=size)["after"] == 3
    assert stamps(path) == after                 # nothing left to pack


def test_bins_of_one_folder_keep_their_own_sorted_files(spark, scratch):
    path = f"{scratch}/t"
    base = spark.range(6000).selectExpr("id", "md5(string(id)) AS x", "'a' AS part")
    base.repartition(24, "id").write.partitionBy("part").parquet(path)
    sizes = files.table_files(spark, path)
    limit = 2 * max(sizes.values())
    bins = files.pack(sizes, limit)
    assert len(bins) > 8
    out = sinks.compact_small_files(spark, path, target_bytes=limit, small_share=1, sort_cols=["x"])
    assert out == {"before": 24, "after": len(bins)}
    assert rows(spark.read.parquet(path)) == rows(base)
    for name in stamps(path):
        found = [r.x for r in spark.read.parquet(name).collect()]
        assert found and found == sorted(found)


def test_bins_hold_every_file_once():
    sizes = {f"f{i}": (i * 37) % 101 + 1 for i in range(60)} | {"huge": 500}
    bins = files.pack(sizes, 128)
    assert sorted(n for b in bins for n in b) == sorted(sizes)
    assert all(sum(sizes[n] for n in b) <= 128 or b == ["huge"] for b in bins)
    assert len(bins) <= 2 * sum(sizes.values()) / 128 + 1


def test_replacement_is_carried_on_after_a_crash(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    spark.range(10).coalesce(1).write.parquet(path)
    old = list(files.table_files(spark, path))
    monkeypatch.setattr(files, "recover", lambda *a: False)     # stops after the journal
    files.replace_files(spark.range(5).coalesce(1), path, old)
    assert spark.read.parquet(path).count() == 10
    monkeypatch.undo()
    assert files.recover(spark, path)
    assert spark.read.parquet(path).count() == 5
    assert not files.recover(spark, path)
    assert not [n for n in os.listdir(path) if n.startswith("_staged") or n.startswith("_replaced")]


@pytest.mark.parametrize("unit", ["day", "month"])
def test_retention_drops_whole_partitions(spark, scratch, unit):
    path = f"{scratch}/t"
    df = (spark.range(24 * 90).selectExpr("id", "timestamp_ntz'2026-01-01 00:00:00' + make_interval(0,0,0,0,id) AS ts")
          .withColumn("day", F.trunc(F.to_date("ts"), "MM") if unit == "month" else F.to_date("ts")))
    df = df.unionByName(spark.createDataFrame([(-1, None, None)], "id long, ts timestamp_ntz, day date"))
    df.coalesce(1).write.partitionBy("day").parquet(path)
    before = stamps(path)
    as_of = dt.datetime(2026, 2, 19, 13, 0)
    out = ops.apply_partition_retention(spark, path, "ts", as_of, 7, unit=unit)
    cutoff = dt.datetime(2026, 2, 12, 13, 0)
    left = spark.read.parquet(path)
    assert left.filter(F.col("ts") < F.lit(cutoff)).count() == 0 and left.filter("ts IS NULL").count() == 1
    deleted = int((cutoff - dt.datetime(2026, 1, 1)).total_seconds() // 3600)
    assert (out["deleted"], out["kept"]) == (deleted, 24 * 90 + 1 - deleted) and left.count() == out["kept"]
    assert out["files_rewritten"] == 1 and out["files_dropped"] == (42 if unit == "day" else 1)
    after = stamps(path)
    assert len(set(before.items()) & set(after.items())) == len(before) - out["files_dropped"] - 1
    again = ops.apply_partition_retention(spark, path, "ts", as_of, 7, unit=unit)
    assert again["deleted"] == 0 and stamps(path) == after


def test_lookup_reads_one_row_group_at_most(spark, scratch):
    path = f"{scratch}/t"
    df = spark.range(400000).selectExpr("id * 2 AS k", "md5(string(id)) AS a", "md5(string(id + 1)) AS b")
    sinks.write_indexed(df.repartition(8), path, "k", block_bytes=1 << 20, files=3)
    import pyarrow.parquet as pq
    groups = [g for p in stamps(path) for g in [pq.ParquetFile(p).metadata]]
    sizes = [m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)]
    assert len(sizes) > 6

    def read(value):
        found = sinks.lookup(spark, path, "k", value)
        out = found.collect()
        scan = found._jdf.queryExecution().executedPlan()
        leaf = scan.collectLeaves().head()
        return out, leaf.metrics().apply("numOutputRows").value()

    hit, scanned = read(123456)
    assert [r.k for r in hit] == [123456] and 0 < scanned <= max(sizes)
    assert read(123457) == ([], 0)              # between two keys: the Bloom filter or the ends
    assert read(-5) == ([], 0)


def test_generations_conform_to_the_declared_schema(spark, scratch):
    from brightlake.sources import landing
    declared = spark.createDataFrame([], "id long, amount decimal(10,2), note string, day date").schema
    root = f"{scratch}/landed"
    spark.createDataFrame([(1, "1.5"), (2, "garbage"), (3, None)], "id int, amount string").write.parquet(
        f"{root}/year=2025/month=1")
    spark.createDataFrame([(4, 2.25, "x")], "id long, amount double, note string").write.parquet(
        f"{root}/year=2025/month=2")
    spark.createDataFrame([(5, None, "y", dt.date(2026, 1, 1), 7)],
                          "id long, amount decimal(10,2), note string, day date, extra int").write.parquet(
        f"{root}/year=2026/month=1")
    got = landing.read_generations(spark, root, declared)
    assert got.columns == [*declared.names, "year", "month"]
    assert [f.dataType for f in got.schema][:4] == [f.dataType for f in declared]
    rows_ = {r.id: (None if r.amount is None else float(r.amount), r.note, r.day, r.year, r.month)
             for r in got.collect()}
    assert rows_ == {1: (1.5, None, None, 2025, 1), 2: (None, None, None, 2025, 1), 3: (None, None, None, 2025, 1),
                     4: (2.25, "x", None, 2025, 2), 5: (None, "y", dt.date(2026, 1, 1), 2026, 1)}
    drift = {(r.delivery.split("landed/")[1], r.column_name): (r.found_type, r.declared_type, r.change)
             for r in landing.schema_drift(spark, root, declared).collect()}
    assert drift == {
        ("year=2025/month=1", "id"): ("int", "bigint", "retyped"),
        ("year=2025/month=1", "amount"): ("string", "decimal(10,2)", "retyped"),
        ("year=2025/month=1", "note"): (None, "string", "missing"),
        ("year=2025/month=1", "day"): (None, "date", "missing"),
        ("year=2025/month=2", "amount"): ("double", "decimal(10,2)", "retyped"),
        ("year=2025/month=2", "day"): (None, "date", "missing"),
        ("year=2026/month=1", "extra"): ("int", None, "extra")}
