import datetime as dt
import os
import time

import pytest

from brightlake.schemas import BRONZE_ORDERS
from brightlake.streaming import incremental


def order(oid, created, total=10.0, cust=1):
    return (oid, cust, 1, "p", "c", total, 1, 0.0, total, "FR", "completed", "card", created)


def land(spark, landing, files):
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, BRONZE_ORDERS).coalesce(1).write.parquet(f"{landing}/f{i}")
        time.sleep(0.05)  # distinct modification times give the landing order


FILES = [
    [order("a", "2026-01-05T10:00:00"), order("b", "2026-01-05T11:00:00"), order("n", None)],
    [order("c", "2026-01-05T00:00:00"), order("a", "2026-01-05T10:00:00"),   # re-delivery
     order("z", "9999-01-01T00:00:00")],                                     # a time far ahead
    [order("b", "2026-02-09T12:00:00", 99.0),      # known id in another month
     order("bad", "2026-02-09T12:00:00", -1.0),    # first landed row of the id is invalid
     order("e", "2026-02-09T13:00:00")],
    [order("d", "2026-01-03T00:00:00"),            # a month late
     order("bad", "2026-02-09T12:00:00", 5.0), order("n", "2026-01-03T00:00:00"),
     order("g", "garbage"), order(None, "2026-01-03T00:00:00")],
]


@pytest.mark.parametrize("files_per_batch", [1, 2, 100])
def test_stream_loses_and_repeats_nothing(spark, scratch, files_per_batch):
    from brightlake.operators.cleaning import clean_orders
    from brightlake.plans import gold
    land(spark, f"{scratch}/landing", FILES)
    silver, gold_path = f"{scratch}/silver", f"{scratch}/gold"
    incremental.run_incremental(spark, f"{scratch}/landing", BRONZE_ORDERS, f"{scratch}/ckpt",
                                silver, gold_path, "2026-01-10",
                                max_files_per_trigger=files_per_batch)
    landed = incremental.with_landing_order(
        spark.read.schema(BRONZE_ORDERS).option("recursiveFileLookup", "true")
        .parquet(f"{scratch}/landing"))
    batch = clean_orders(landed, "2026-01-10")
    got = spark.read.parquet(silver).drop("_batch", "order_month").select(*batch.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))
    assert sorted(r.order_id for r in got.collect()) == ["a", "b", "c", "d", "e", "g", "n", "z"]
    daily = gold.daily_sales(batch)
    stream = spark.read.parquet(gold_path).drop("month").select(*daily.columns)
    assert sorted(map(str, stream.collect())) == sorted(map(str, daily.collect()))


def test_replayed_batch_changes_nothing(spark, scratch):
    silver, gold_path = f"{scratch}/silver", f"{scratch}/gold"
    raw = [spark.createDataFrame(rows, BRONZE_ORDERS) for rows in FILES]
    for batch_id in (0, 0, 1, 2, 2, 3, 1, 0):
        incremental.upsert_batch(raw[batch_id], batch_id, silver, gold_path, "2026-01-10")
    assert sorted(r.order_id for r in spark.read.parquet(silver).collect()) == \
        ["a", "b", "c", "d", "e", "g", "n", "z"]
    days = {r.date: r.total_orders for r in spark.read.parquet(gold_path).collect()}
    assert days[dt.date(2026, 1, 5)] == 3 and days[dt.date(2026, 2, 9)] == 1


def test_batch_opens_few_key_files(spark, scratch):
    from pyspark.sql import functions as F

    from brightlake.streaming.seen import SeenKeys
    index = SeenKeys(spark, f"{scratch}/seen", "k", buckets=64)

    def keys(start, n):
        return spark.range(start, start + n).select(F.concat(F.lit("order-"), "id").alias("k"))

    for i in range(6):
        index.remember(keys(10000 * i, 5000), i)
    files = len(index.key_folders())
    assert files == 6 * 64
    new = keys(10**6, 100)
    assert len(index.folders_to_open(new, 9)) < 0.05 * files
    mixed = new.unionByName(keys(20000, 3)).unionByName(spark.createDataFrame([("order-5",)], "k string"))
    opened = index.folders_to_open(mixed, 9)
    assert len(opened) < 0.05 * files
    left = index.unseen(mixed, 9)
    scan = [n for n in left.inputFiles() if "/seen/" in n]
    assert 0 < len(scan) < 0.05 * files
    assert sorted(r.k for r in left.collect()) == sorted(r.k for r in new.collect())
    assert index.unseen(mixed, 2).count() == 103          # a batch's own keys do not count
    assert index.merge_batches(5) == 5
    assert len(index.key_folders()) == 2 * 64
    assert sorted(r.k for r in index.unseen(mixed, 9).collect()) == sorted(r.k for r in new.collect())
    assert index.unseen(keys(0, 60000), 9).count() == 30000


def test_keys_without_a_filter_are_opened(spark, scratch):
    from brightlake.session import delete_path
    from brightlake.streaming.seen import SeenKeys
    index = SeenKeys(spark, f"{scratch}/seen", "k", buckets=4)
    df = spark.range(100).selectExpr("string(id) k")
    index.remember(df, 0)
    for _, path in index.filter_folders().values():
        delete_path(spark, path)
    assert index.unseen(df, 1).count() == 0


def test_late_row_reads_cells_of_its_day_and_no_silver(spark, scratch):
    from brightlake.plans import gold
    silver, gold_path, cells = f"{scratch}/silver", f"{scratch}/gold", f"{scratch}/silver_cells"
    days = [f"2026-0{m}-{d:02d}T10:00:00" for m in (1, 2) for d in range(1, 11)]
    rows = [order(f"o{i}-{d}", t, 5.0 + i, i) for i in range(3) for d, t in enumerate(days)]
    incremental.upsert_batch(spark.createDataFrame(rows, BRONZE_ORDERS), 0, silver, gold_path, "2026-02-01")
    seen = {}
    reader = type(spark.read)
    original = reader.parquet

    def spy(self, *paths, **kw):
        for path in paths:
            seen[path] = seen.get(path, 0) + 1
        return original(self, *paths, **kw)

    before = {n: os.stat(f"{gold_path}/{n}").st_mtime_ns for n in os.listdir(gold_path) if "=" in n}
    reader.parquet = spy
    try:
        late = spark.createDataFrame([order("late", days[4], 7.0, 99)], BRONZE_ORDERS)
        incremental.upsert_batch(late, 1, silver, gold_path, "2026-02-01")
    finally:
        reader.parquet = original
    assert not [p for p in seen if p.startswith(silver + "/") or p == silver]
    assert cells in seen
    after = {n: os.stat(f"{gold_path}/{n}").st_mtime_ns for n in os.listdir(gold_path) if "=" in n}
    assert [n for n in after if after[n] != before.get(n)] == ["month=2026-01"]
    whole = spark.read.parquet(silver).drop("_batch", "order_month")
    want = gold.daily_sales(whole)
    got = spark.read.parquet(gold_path).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_merged_cells_give_the_same_days(spark, scratch):
    from brightlake.plans import gold
    silver, gold_path, cells = f"{scratch}/silver", f"{scratch}/gold", f"{scratch}/silver_cells"
    for i, rows in enumerate(FILES):
        incremental.upsert_batch(spark.createDataFrame(rows, BRONZE_ORDERS), i, silver, gold_path, "2026-01-10")
    like = spark.read.parquet(silver)
    before = sorted(map(str, gold.merge_cells(incremental.read_cells(spark, cells, like)).collect()))
    assert incremental.merge_day_cells(spark, cells, like, 3) > 1
    assert incremental.merge_day_cells(spark, cells, like, 3) == 0
    after = incremental.read_cells(spark, cells, like)
    assert sorted(map(str, gold.merge_cells(after).collect())) == before
    row = [order("later", "2026-01-05T09:00:00", 3.0, 7)]
    incremental.upsert_batch(spark.createDataFrame(row, BRONZE_ORDERS), 9, silver, gold_path, "2026-01-10")
    want = gold.daily_sales(spark.read.parquet(silver))
    got = spark.read.parquet(gold_path).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_batches_store_quality_and_run_rows(spark, scratch):
    from brightlake.operators import quality
    from brightlake.operators.cleaning import clean_orders
    silver, gold_path = f"{scratch}/silver", f"{scratch}/gold"
    options = {"dq_path": f"{scratch}/dq", "runs_path": f"{scratch}/runs"}
    for i in (0, 1, 1, 2, 3):
        incremental.upsert_batch(spark.createDataFrame(FILES[i], BRONZE_ORDERS), i, silver, gold_path,
                                 "2026-01-10", **options)
    runs = {r["_batch"]: (r.status, r.rows_read, r.rows_written)
            for r in spark.read.parquet(f"{scratch}/runs").collect()}
    assert runs == {0: ("success", 3, 3), 1: ("success", 3, 2), 2: ("success", 3, 1), 3: ("success", 5, 2)}
    dq = spark.read.parquet(f"{scratch}/dq")
    for i in range(4):
        one = spark.read.parquet(silver).filter(f"_batch = {i}").drop("_batch", "order_month")
        want = quality.run_rules(one, "orders", "silver", quality.order_rules(), "2026-01-10")
        assert sorted(map(str, dq.filter(f"_batch = {i}").drop("_batch").collect())) == \
            sorted(map(str, want.collect()))
    assert clean_orders(spark.createDataFrame(FILES[0], BRONZE_ORDERS), "2026-01-10").count() == 3


def test_failed_batch_is_logged(spark, scratch):
    raw = spark.createDataFrame(FILES[0], BRONZE_ORDERS).drop("quantity")
    with pytest.raises(Exception, match="quantity"):
        incremental.upsert_batch(raw, 0, f"{scratch}/s", f"{scratch}/g", "2026-01-10", runs_path=f"{scratch}/runs")
    row = spark.read.parquet(f"{scratch}/runs").first()
    assert row.status == "failed" and "quantity" in row.error_msg and row.rows_read == 3


def small_tables(spark, path, times):
    """One order of one line for each of the times."""
    orders = [(i, i, dt.datetime.fromisoformat(t)) for i, t in enumerate(times, 1)]
    lines = [(i, 1, 1, 5.0, 50.0, 0.0, "N") for i in range(1, len(times) + 1)]
    for name, rows, schema in (
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
            ("lineitem", lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, "
                                "l_extendedprice double, l_discount double, l_returnflag string"),
            ("part", [(1, "p", "c")], "p_partkey long, p_name string, p_type string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")


@pytest.mark.parametrize("times,read", [
    (["1996-01-05", "1998-01-05"], [1, 1, 2]), (["1998-01-05"], [1, 0, 1]), ([], [0, 0, 0])])
def test_each_delivery_is_a_batch(spark, scratch, times, read):
    """Deliveries of fewer files than a batch takes, and of no rows."""
    from brightlake.registry import QUERIES
    small_tables(spark, scratch, times)
    got = {r.batch: (r.rows_tested, r.rows_failed)
           for r in QUERIES["stream_quality"](spark, scratch).filter("check_name = 'run'").collect()}
    assert got == {0: (read[0], 0), 1: (read[1], 0), 2: (read[2], read[2])}


def test_batch_sorts_its_rows_once_and_counts_those_without_an_id(spark, scratch, monkeypatch):
    plans, frames = [], type(spark.range(1))
    persist = frames.persist

    def spy(self, *args):
        plans.append(self._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        return persist(self, *args)

    monkeypatch.setattr(frames, "persist", spy)
    rows = [order(None, "2026-01-05T10:00:00")] * 40 + [order("a", "2026-01-05T10:00:00")] * 3
    incremental.upsert_batch(spark.createDataFrame(rows, BRONZE_ORDERS), 0, f"{scratch}/s",
                             f"{scratch}/g", "2026-01-10", runs_path=f"{scratch}/runs")
    aggregates, shuffle = plans[0].rindex("Aggregate"), plans[0].index("REPARTITION_BY_NUM")
    assert aggregates < shuffle          # printed from the top: none below the shuffle
    run = spark.read.parquet(f"{scratch}/runs").first()
    assert (run.rows_read, run.rows_written) == (43, 1)
