"""Incremental clean (T1) and incremental daily aggregate.

``readStream`` picks up only new landing files, a bounded number at a time.
The stream keeps no state and drops no late row; each micro-batch
(``foreachBatch``) does this:

1. keeps one raw row per ``order_id`` inside the batch, the first landed;
2. drops ids that an earlier batch has seen, by the index of ``streaming/seen.py``
   (hash buckets with Bloom filters, whatever month or state of validity the row had), so that
   only key files that may hold an id of the batch are opened - the first landed row of an
   id wins over all batches, as in the batch cleaning;
3. writes the batch's ids to its own partitions of the index, cleans the rows with the batch's
   own cleaning function, and writes them to the batch's own silver partitions;
4. writes the batch's own (day, customer) and (day, category) cells, which add up, and
   recomputes the days that the batch touches from the stored cells of those days. The days are
   named to the scans as literals; silver is never read.

Every write overwrites the batch's own partitions, or whole days computed from them, so steps
1-4 give the same tables when a batch runs again after an executor or driver loss.
``merge_day_cells`` and ``SeenKeys.merge_batches`` fold what old batches left into one.
"""

from __future__ import annotations

import datetime as _dt
import re
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brightlake.operators import quality
from brightlake.operators.cleaning import clean_order_rows, parse_if_text
from brightlake.operators.dedupe import first_of_ids
from brightlake.plans import gold
from brightlake.plans.ops import RUN_SCHEMA
from brightlake.session import path_exists
from brightlake.sources.files import read_files, recover, replace_files, table_files
from brightlake.sources.landing import with_landing_order
from brightlake.streaming.seen import SeenKeys

FILES_PER_TRIGGER = 1000
LANDED = ("_landed_at", "_landed_file", "_landed_row")


def touched_days(cells: DataFrame) -> list:
    """Distinct days of a batch as text (None: no day): bounded by the calendar."""
    return [r[0] for r in cells.select(F.col("order_date").cast("string")).distinct().collect()]


def _one_of(column: str, values: list, kind: str = "string"):
    # One text for all values: a column object a day costs the driver seconds.
    known = ", ".join(f"CAST('{v}' AS {kind})" for v in values if v is not None)
    keep = F.expr(f"`{column}` IN ({known})") if known else F.lit(False)
    return keep | F.col(column).isNull() if None in values else keep


def _months(days: list) -> list:
    return sorted({d and d[:-3] for d in days}, key=str)


def in_days(cells: DataFrame, days: list) -> DataFrame:
    """Cells of the given days by literal filters: on the month, which prunes folders, and on
    the day, which prunes row groups."""
    return cells.filter(_one_of("_month", _months(days)) & _one_of("order_date", days, "date"))


def _cells(orders: DataFrame) -> DataFrame:
    return gold.day_cells(orders).select(*gold.CELL_KEYS, "n", "rev").withColumn(
        "_month", _month("order_date"))


def _month(day: str):
    """The month as text; the day's own text without its last part, so far years have theirs."""
    return F.regexp_replace(F.col(day).cast("string"), "-\\d\\d$", "")


def _cell_schema(orders: DataFrame) -> StructType:
    return StructType([f for f in _cells(orders).schema]).add("_batch", "long")


def read_cells(spark: SparkSession, path: str, like: DataFrame, names=()) -> DataFrame:
    """Stored day cells (of some files); ``like`` are orders, which give the cells' types."""
    return (spark.read.schema(_cell_schema(like)).option("basePath", path)
            .parquet(*(names or [path])))


def _overwrite(df: DataFrame, path: str, *partitions: str, sort=()) -> None:
    out = df.hint("rebalance", *partitions)
    (out.sortWithinPartitions(*partitions, *sort).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path))


def write_cells(orders: DataFrame, batch_id: int, path: str) -> DataFrame:
    """The cells of the batch's orders as its own partitions; returns them as read back."""
    cells = _cells(orders).withColumn("_batch", F.lit(batch_id).cast("long"))
    _overwrite(cells, path, "_month", "_batch", sort=["order_date"])
    if not path_exists(orders.sparkSession, path):   # no cell at all so far
        return cells.limit(0)
    return read_cells(orders.sparkSession, path, orders).filter(F.col("_batch") == batch_id)


def write_days(cells: DataFrame, days: list, path: str) -> None:
    """Put the gold rows of ``days``, computed from their stored cells, in the place of the old ones.

    The table has one small file a month. Other days of a touched month are carried over from
    its file, which is replaced by a journal that a crash cannot leave half done.
    """
    spark = cells.sparkSession
    daily = gold.daily_of_cells(gold.merge_cells(in_days(cells, days))).withColumn("month", _month("date"))
    old: list[str] = []
    if path_exists(spark, path):
        recover(spark, path)
        names = {"month=" + (m or "__HIVE_DEFAULT_PARTITION__") for m in _months(days)}
        old = [f for f in table_files(spark, path) if f.split("/")[-2] in names]
    if old:
        kept = read_files(spark, path, old).filter(~F.coalesce(_one_of("date", days, "date"), F.lit(False)))
        daily = daily.unionByName(kept.withColumn("month", F.col("month").cast("string"))
                                  .select(*daily.columns))
    # One row a day: a month is a handful of rows.
    replace_files(daily.repartition("month").sortWithinPartitions("month", "date"), path, old, ["month"])


def merge_day_cells(spark: SparkSession, path: str, like: DataFrame, before: int) -> int:
    """Fold each month's cells of the batches below ``before`` into one partition of the month.

    For batches that the stream's checkpoint has left behind: they are not run again. The old
    files go and the merged ones come in one replacement that a crash cannot leave half done.
    Returns the number of folders merged.
    """
    recover(spark, path)
    folders: dict[str, list[str]] = {}
    for name in table_files(spark, path):
        m = re.search(r"^(.*/_month=[^/]*)/_batch=(\d+)/", name)
        if int(m[2]) < before:
            folders.setdefault(m[1], []).append(name)
    old = [n for names in folders.values() if len({x.rsplit("/", 1)[0] for x in names}) > 1 for n in names]
    if not old:
        return 0
    merged = (gold.merge_cells(read_cells(spark, path, like, old).drop("_batch"))
              .withColumn("_month", _month("order_date"))
              .withColumn("_batch", F.lit(before - 1).cast("long")))
    replace_files(merged.repartition("_month").sortWithinPartitions("_month", "order_date"), path, old,
                  ["_month", "_batch"])
    return len({n.rsplit("/", 1)[0] for n in old})


def silver_batch(spark: SparkSession, path: str, like: DataFrame, batch_id: int) -> DataFrame:
    """The rows of one batch in silver, typed as ``like``."""
    if not path_exists(spark, path):
        return like.limit(0)
    schema = StructType(list(like.schema)).add("order_month", "string").add("_batch", "long")
    return spark.read.schema(schema).parquet(path).filter(F.col("_batch") == batch_id)


def _log(rows: DataFrame, batch_id: int, path: str) -> None:
    """Rows about a batch, in its own partition: a re-run replaces them."""
    (rows.withColumn("_batch", F.lit(batch_id).cast("long")).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path))


def upsert_batch(raw: DataFrame, batch_id: int, silver_path: str, gold_path: str, as_of,
                 keys_path: str | None = None, cells_path: str | None = None,
                 dq_path: str | None = None, runs_path: str | None = None, rules=None) -> None:
    """Steps 1-4 above for one micro-batch of raw rows (also usable as a plain batch step).

    With ``dq_path`` the quality ``rules`` (D1, those of orders) of the batch's clean rows are
    counted by the silver write itself; with ``runs_path`` the batch has a run-log row (S13) with
    rows read and written. A batch that fails has its row too, and the error goes on.
    """
    spark = raw.sparkSession
    started, t0 = _dt.datetime.now(), time.monotonic()
    rules = quality.order_rules() if rules is None else rules
    counts = {"read": 0, "written": 0}

    def run(status: str, error: str | None = None) -> None:
        if runs_path:
            ms = int((time.monotonic() - t0) * 1000)
            _log(spark.createDataFrame(
                [("stream_orders", "silver", status, counts["read"], counts["written"], ms, error,
                  started, _dt.datetime.now())], RUN_SCHEMA), batch_id, runs_path)

    try:
        _merge_batch(raw, batch_id, silver_path, gold_path, as_of,
                     keys_path or f"{silver_path.rstrip('/')}_keys",
                     cells_path or f"{silver_path.rstrip('/')}_cells", dq_path, rules, counts)
    except Exception as e:
        run("failed", str(e))
        raise
    run("success")


def _merge_batch(raw, batch_id, silver_path, gold_path, as_of, keys_path, cells_path, dq_path, rules,
                 counts) -> None:
    spark = raw.sparkSession
    index = SeenKeys(spark, keys_path, "order_id")
    order = [c for c in LANDED if c in raw.columns] or ["created_at"]
    # Rows without an id would go in the cleaning; they are counted where they are read.
    lacking = Observation(f"stream_read_{uuid.uuid4().hex[:12]}")
    rows = parse_if_text(raw, "created_at").observe(
        lacking, F.count_if(F.col("order_id").isNull()).alias("no_id"))
    whole = first_of_ids(rows, "order_id", order, "_rows").drop(*LANDED).persist()
    try:
        # Computes the whole batch once; what follows reads it.
        known = whole.agg(F.sum("_rows"), F.count("order_id")).first()
        counts["read"] = (known[0] or 0) + (quality.observed_counts(lacking) or {}).get("no_id", 0)
        batch = whole.drop("_rows")
        if known[1]:
            index.remember(index.unseen(batch, batch_id), batch_id)
        # From here on the batch is what its key partitions hold, so a re-run agrees.
        ids = index.own(batch, batch_id)
        clean = clean_order_rows(batch.join(ids, "order_id", "left_semi"), as_of)
        observed, seen = quality.observed_rules(clean, rules, "stream_dq")
        _overwrite(observed.withColumn("order_month", F.date_format("created_at", "yyyy-MM"))
                   .withColumn("_batch", F.lit(batch_id).cast("long")),
                   silver_path, "order_month", "_batch")
        tested = quality.observed_counts(seen)
        if tested is None:   # the plan of an empty batch may have lost its counters
            own = silver_batch(spark, silver_path, clean, batch_id)
            tested = own.agg(*quality.rule_counts(rules)).first().asDict()
        counts["written"] = tested["rows_tested"]
        if dq_path:
            _log(quality.counted_results(spark, tested, rules, "orders", "silver", as_of), batch_id, dq_path)
        days = touched_days(write_cells(clean, batch_id, cells_path)) if counts["written"] else []
        if days:
            write_days(read_cells(spark, cells_path, clean), days, gold_path)
    finally:
        whole.unpersist()


def start_incremental(spark: SparkSession, landing_dir: str, schema: StructType,
                      checkpoint_dir: str, silver_path: str, gold_path: str, as_of,
                      max_files_per_trigger: int = FILES_PER_TRIGGER,
                      available_now: bool = True, **options):
    """Start the landing -> silver -> gold stream; returns the ``StreamingQuery``.

    Other options go to ``upsert_batch``.
    """
    raw = with_landing_order(
        spark.readStream.schema(schema).option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing_dir))
    writer = (raw.writeStream
              .foreachBatch(lambda df, batch_id: upsert_batch(df, batch_id, silver_path,
                                                              gold_path, as_of, **options))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="60 seconds")
    return writer.start()


def run_incremental(spark: SparkSession, *args, **kwargs) -> None:
    """Run the stream until the landing zone is drained (``availableNow``)."""
    q = start_incremental(spark, *args, **kwargs)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
