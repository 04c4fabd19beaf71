"""Operational tables as data (S13-S16): run log, catalog, storage stats, retention."""

from __future__ import annotations

import datetime as _dt
import re
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from brightlake.functions.dates import as_ts_lit
from brightlake.sources.files import (delete_files, file_name, read_files, recover, replace_files,
                                      table_files)
from brightlake.sources.sinks import truncate_insert

RUN_SCHEMA = ("pipeline_name string, layer string, status string, rows_read long, "
              "rows_written long, duration_ms long, error_msg string, "
              "started_at timestamp_ntz, finished_at timestamp_ntz")


def table_catalog(tables: dict[str, DataFrame], layer: str, as_of,
                  location_root: str = "", fmt: str = "parquet") -> DataFrame:
    """One row per table with its row count (one small aggregate per table)."""
    rows = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(layer).alias("layer"),
            F.lit(f"{location_root.rstrip('/')}/{layer}/{name}" if location_root else None)
             .cast("string").alias("location"),
            F.lit(fmt).alias("format"), "row_count",
            F.lit(df.schema.json()).alias("schema_json"),
            as_ts_lit(as_of).alias("last_updated"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def written_catalog(spark: SparkSession, tables: dict[str, tuple[str, str]], as_of) -> DataFrame:
    """S14 from written tables (``name -> (layer, path)``): row counts and sizes in bytes."""
    rows = None
    for name, (layer, path) in tables.items():
        one = table_catalog({name: spark.read.parquet(path)}, layer, as_of).withColumn(
            "location", F.lit(path))
        size = storage_stats(spark, {layer: path}).select("size_bytes")
        one = one.crossJoin(size)  # one row with one row
        rows = one if rows is None else rows.unionByName(one)
    return rows


def refresh_catalog(catalog: DataFrame, fresh: DataFrame) -> DataFrame:
    """S14 upsert on (table_name, layer): fresh rows replace old ones."""
    from brightlake.operators.upsert import upsert
    return upsert(catalog, fresh, ["table_name", "layer"])


def storage_stats(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Files and size (MB, 2 dp) per layer; file contents are never read."""
    out = None
    for layer, path in layers.items():
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(path).select("path", "length"))
        one = files.agg(F.count(F.lit(1)).alias("files"),
                        F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes")).select(
            F.lit(layer).alias("layer"), "files", "size_bytes",
            F.round(F.col("size_bytes").cast("decimal(24,0)") / (1024 * 1024), 2)
             .cast("double").alias("size_mb"))
        out = one if out is None else out.unionByName(one)
    return out


def retain(df: DataFrame, ts_col: str, as_of, days: int = 30) -> DataFrame:
    """Rows whose ``ts_col`` is within the last ``days`` (the kept rows)."""
    cutoff = as_ts_lit(as_of) - F.make_interval(days=F.lit(days))
    return df.filter(F.col(ts_col) >= cutoff)


def expired(df: DataFrame, ts_col: str, as_of, days: int = 30) -> DataFrame:
    """The rows a retention run deletes (their count is the deleted count)."""
    cutoff = as_ts_lit(as_of) - F.make_interval(days=F.lit(days))
    return df.filter(F.col(ts_col) < cutoff)


def apply_retention(spark: SparkSession, path: str, ts_col: str, as_of, days: int = 30) -> dict:
    """Delete what has expired from a written table; returns kept and deleted counts.

    Rows without a time are kept. One conditional aggregate counts both parts.
    """
    df = spark.read.parquet(path)
    cutoff = as_ts_lit(as_of) - F.make_interval(days=F.lit(days))
    old = F.coalesce(F.col(ts_col) < cutoff, F.lit(False))
    n = df.agg(F.count_if(~old).alias("kept"), F.count_if(old).alias("deleted")).first().asDict()
    if n["deleted"]:
        truncate_insert(df.filter(~old), path)
    return n


def apply_partition_retention(spark: SparkSession, path: str, ts_col: str, as_of, days: int = 30,
                              day_col: str = "day", unit: str = "day") -> dict:
    """S16 on a table whose partition column ``day_col`` is the day (or, with ``unit="month"``, the
    first day of the month) of ``ts_col``.

    Partitions that end before the cutoff are dropped whole, by their folders; their rows are
    counted from the files' footers. Of the partition that the cutoff falls into only the files
    that hold an expired row are rewritten. Every other file, and the partition
    without a time, stays as it is. Returns kept and deleted rows, and how many files were
    dropped and rewritten.
    """
    recover(spark, path)
    cutoff = spark.range(1).select(
        (as_ts_lit(as_of) - F.make_interval(days=F.lit(days))).alias("c")).first()[0]
    sizes = table_files(spark, path)
    expired_files, edge_files, kept_files = [], [], []
    for name in sizes:
        m = re.search(f"/{re.escape(day_col)}=(\\d{{4,}}-\\d\\d-\\d\\d)/", name)
        start = _dt.date.fromisoformat(m[1]) if m else None
        if start is None or start > cutoff.date():
            kept_files.append(name)
            continue
        end = start + _dt.timedelta(days=1) if unit == "day" \
            else (start + _dt.timedelta(days=31)).replace(day=1)
        whole = _dt.datetime(end.year, end.month, end.day) <= cutoff
        (expired_files if whole else edge_files).append(name)

    def rows(names: list[str]) -> int:
        return read_files(spark, path, names).count() if names else 0

    deleted, kept = rows(expired_files), rows(kept_files)
    old = F.coalesce(F.col(ts_col) < as_ts_lit(cutoff), F.lit(False))
    rewrite = []
    if edge_files:
        edge = read_files(spark, path, edge_files)
        counts = (edge.groupBy(file_name().alias("_file"))
                  .agg(F.count_if(old).alias("gone"), F.count_if(~old).alias("left")).collect())
        rewrite = [r["_file"] for r in counts if r["gone"]]
        deleted += sum(r["gone"] for r in counts)
        kept += sum(r["left"] for r in counts)
    if rewrite:
        left = read_files(spark, path, rewrite).filter(~old)
        replace_files(left, path, [*expired_files, *rewrite], [day_col])
    elif expired_files:
        delete_files(spark, path, expired_files)
    return {"kept": kept, "deleted": deleted, "files_dropped": len(expired_files),
            "files_rewritten": len(rewrite)}


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter to ``df``; it is filled by whatever action runs ``df``."""
    obs = Observation(f"in_{name}_{int(time.time() * 1000)}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_observed(df: DataFrame, path: str, name: str, layer: str, rows_read=None,
                   mode: str = "overwrite", partition_by=None,
                   runs_path: str | None = None) -> DataFrame:
    """Write ``df`` once and return its run-log row.

    Rows written are counted by ``observe`` during the write itself: no
    second scan and no recount of a recomputed plan. With ``runs_path`` the
    row is also appended to the run log, for a failed write too (then the
    error is re-raised).
    """
    spark = df.sparkSession
    obs = Observation(f"rows_{name}_{int(time.time() * 1000)}")
    started = _dt.datetime.now()
    t0 = time.monotonic()
    status, err, written = "success", None, 0
    try:
        w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        written = int(obs.get.get("rows", 0))
        if isinstance(rows_read, Observation):
            rows_read = int(rows_read.get.get("rows", 0))
    except Exception as e:  # noqa: BLE001 - recorded in the run log, then re-raised
        status, err = "failed", str(e)
        if isinstance(rows_read, Observation):
            rows_read = None
    ms = int((time.monotonic() - t0) * 1000)
    run = spark.createDataFrame(
        [(name, layer, status, rows_read, written, ms, err, started, _dt.datetime.now())],
        RUN_SCHEMA)
    if runs_path:
        run.write.mode("append").parquet(runs_path)
    if status == "failed":
        raise RuntimeError(f"{name} failed: {err}")
    return run
