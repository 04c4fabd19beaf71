"""Table sinks (S5-S9, S11, S17). Parquet folders, or tables of the session's catalog.

A plain Parquet folder has no atomic replace: a replacing write goes to a new
folder beside the table, which then takes the table's place. So a plan may read
the very table that it replaces, and a failed write leaves the old one whole.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightlake.functions.dates import month_start
from brightlake.session import replace_path
from brightlake.sources.files import (file_name, pack, read_files, recover, replace_files,
                                      table_files)


def replace_table(df: DataFrame, path: str, partition_by=None, sort_within=None,
                  compression: str = "snappy") -> str:
    """Create-or-replace as snappy Parquet (optionally partitioned / sorted for skipping)."""
    out = df.hint("rebalance", *partition_by) if partition_by else df
    out = out.sortWithinPartitions(*sort_within) if sort_within else out
    w = out.write.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    beside = f"{path.rstrip('/')}__new_{uuid.uuid4().hex[:12]}"
    w.parquet(beside)
    replace_path(df.sparkSession, beside, path)
    return path


def write_monthly(df: DataFrame, path: str, ts_col: str = "created_at",
                  month_col: str = "created_month") -> str:
    """The month transform as a derived partition column."""
    return replace_table(df.withColumn(month_col, month_start(ts_col)), path,
                         partition_by=[month_col])


def write_partitions(df: DataFrame, path: str, partition_col: str = "period") -> str:
    """Identity partitions, replacing only the partitions present in ``df``."""
    (df.hint("rebalance", partition_col).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))
    return path


def append_rows(df: DataFrame, path: str, inserted_at=None) -> str:
    """Append (stamping ``inserted_at`` when given)."""
    out = df if inserted_at is None else df.withColumn(
        "inserted_at", F.lit(inserted_at).cast("timestamp_ntz"))
    out.write.mode("append").parquet(path)
    return path


def create_namespace(spark: SparkSession, name: str) -> None:
    """S11."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def truncate_insert(df: DataFrame, path: str, partition_by=None) -> str:
    """Truncate the table, then insert. ``df`` may read the table itself."""
    return replace_table(df, path, partition_by)


def save_table(df: DataFrame, name: str, partition_by=None, v2: bool = False) -> str:
    """S5 in the session's catalog: create or replace the table ``name``.

    ``v2`` uses ``writeTo(...).createOrReplace()`` for catalogs that support it;
    the built-in session catalog takes ``saveAsTable``.
    """
    if v2:
        w = df.writeTo(name)
        if partition_by:
            w = w.partitionedBy(*[F.col(c) for c in partition_by])
        w.createOrReplace()
        return name
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return name


#: Rows of one compacted file, about.
FILE_ROWS = 4_000_000


def compact(df: DataFrame, path: str, sort_cols, file_rows: int = FILE_ROWS) -> str:
    """Rewrite into sorted, range-partitioned files of about ``file_rows`` rows."""
    files = max(1, -(-df.count() // file_rows))
    out = df.repartitionByRange(files, *sort_cols).sortWithinPartitions(*sort_cols)
    return replace_table(out, path)


#: Bytes of a file that compaction aims at, and the share of them below which a file is small.
TARGET_BYTES = 128 << 20
SMALL_SHARE = 0.75


def compact_small_files(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES,
                        small_share: float = SMALL_SHARE, sort_cols=()) -> dict:
    """S17 by bins: the small files of each partition folder are packed into files of about
    ``target_bytes``; every other file stays as it is.

    Sizes come from the listing. A small file that finds no partner in its folder stays too. All
    bins are rewritten by one job, a bin a task (``target_bytes`` at most), sorted by ``sort_cols``.
    Returns the numbers of files before and after.
    """
    recover(spark, path)
    sizes = table_files(spark, path)
    folders: dict[str, dict[str, int]] = {}
    for name, size in sizes.items():
        if size < small_share * target_bytes:
            folders.setdefault(name.rsplit("/", 1)[0], {})[name] = size
    bins = [names for small in folders.values() for names in pack(small, target_bytes) if len(names) > 1]
    if not bins:
        return {"before": len(sizes), "after": len(sizes)}
    old = [name for names in bins for name in names]
    place = spark.createDataFrame([(name, i) for i, names in enumerate(bins) for name in names],
                                  "_file string, _bin int")
    table = spark.read.parquet(path)
    partitions = partition_columns(spark, path)
    # One row a small file: the map of files to bins is a part of the listing, so it is broadcast.
    # The writer wants the rows by partition and bin; a sort that begins so is the one it keeps.
    rows = (read_files(spark, path, old).withColumn("_file", file_name())
            .join(F.broadcast(place), "_file").repartitionById(len(bins), F.col("_bin"))
            .sortWithinPartitions(*[F.col(f"`{c}`") for c in partitions], "_bin", *sort_cols))
    new = replace_files(rows.select(*table.columns, "_bin"), path, old, [*partitions, "_bin"],
                        drop="_bin")
    return {"before": len(sizes), "after": len(sizes) - len(old) + len(new)}


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a written table, in the order of its folders."""
    names = spark.read.parquet(path).inputFiles()
    parts = names[0][len(_root(names[0], path)):].split("/")[:-1] if names else []
    # Escaped once as a folder's name and once more in the URI.
    return [unquote(unquote(p.split("=", 1)[0])) for p in parts if "=" in p]


def _root(name: str, path: str) -> str:
    """The part of a file's URI that names the table's folder."""
    last = path.rstrip("/").rsplit("/", 1)[-1]
    return name[:name.index(f"/{last}/") + len(last) + 2]


#: Rows of one group of an indexed table's file: what a lookup reads at most.
INDEX_BLOCK_BYTES = 8 << 20


def write_indexed(df: DataFrame, path: str, key: str, block_bytes: int = INDEX_BLOCK_BYTES,
                  files: int | None = None) -> str:
    """a table for lookups by ``key``: range-partitioned and sorted by it, so that the
    least and greatest key of a row group leave one group to read, with a Parquet Bloom filter
    of the key, so that a key that is not there leaves none."""
    parts = files or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    beside = f"{path.rstrip('/')}__new_{uuid.uuid4().hex[:12]}"
    (df.repartitionByRange(parts, key).sortWithinPartitions(key).write
     .option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option("parquet.bloom.filter.adaptive.enabled", "true")
     .option("parquet.block.size", block_bytes).parquet(beside))
    replace_path(df.sparkSession, beside, path)
    return path


def lookup(spark: SparkSession, path: str, key: str, value) -> DataFrame:
    """Rows of one key: an equality filter that reaches the reader's statistics and filters."""
    table = spark.read.parquet(path)
    return table.filter(F.col(key) == F.lit(value).cast(table.schema[key].dataType))
