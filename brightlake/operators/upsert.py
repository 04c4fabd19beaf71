"""Keyed upsert (S8): ``INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols``.

The source is collapsed to one row per key (by ``source_order``, ties by the
greatest row). One full outer join on the keys (unique on each side, so no skew): rows only
in the target stay, rows only in the source are inserted, and matched rows
take ``update_cols`` from the source and keep every other column. Running it
twice with the same source gives the same table (idempotent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightlake.operators.dedupe import latest_by
from brightlake.session import path_exists, written
from brightlake.sources.files import file_name, read_files, recover, replace_files


def upsert(target: DataFrame, source: DataFrame, keys, update_cols=None,
           source_order=None) -> DataFrame:
    keys = list(keys)
    if update_cols is None:
        update_cols = [c for c in source.columns if c not in keys]
    # Two source rows of one key would give two rows: the latest (or greatest) one counts.
    source = latest_by(source, keys, source_order or [])
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in source.columns], F.lit(True).alias("_in_s"))
    cond = [F.col(f"t__{k}") == F.col(f"s__{k}") for k in keys]
    j = t.join(s, cond, "full_outer")
    in_s = F.col("_in_s").isNotNull()
    in_t = F.col("_in_t").isNotNull()
    out = []
    for c in target.columns:
        tc = F.col(f"t__{c}")
        sc = F.col(f"s__{c}") if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        if c in keys:
            out.append(F.coalesce(tc, sc).alias(c))
        elif c in update_cols:
            out.append(F.when(in_s, sc).otherwise(tc).alias(c))
        else:
            out.append(F.when(in_t, tc).otherwise(sc).alias(c))
    return j.select(*out)


def upsert_partitions(spark, path: str, source: DataFrame, keys, partition_col: str,
                      update_cols=None, source_order=None) -> None:
    """S8 on a partitioned Parquet table without a merge-capable catalog.

    The partition values that the source touches are read from it and named to
    the scan as literals, so only those folders are read, merged and rewritten
    (dynamic partition overwrite). The merged partitions are written to the
    scratch folder first, so the final write never reads what it overwrites.
    The keys must determine the partition (e.g. period + product). Creates the
    table when the folder does not exist yet.
    """
    keys = list(keys)
    if partition_col not in keys:
        raise ValueError("the partition column must be part of the upsert keys")
    if not path_exists(spark, path):
        merged = latest_by(source, keys, source_order or [])
    else:
        target = spark.read.parquet(path)
        values = [r[0] for r in source.select(partition_col).distinct().collect()]
        known = [v for v in values if v is not None]
        touched = F.col(partition_col).isin(known) if known else F.lit(False)
        if None in values:
            touched = touched | F.col(partition_col).isNull()
        merged = written(upsert(target.filter(touched), source.select(*target.columns), keys,
                                update_cols, source_order), "upsert")
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition_col).parquet(path))


def upsert_files(spark, path: str, source: DataFrame, keys, update_cols=None, source_order=None,
                 partition_by=()) -> dict:
    """S8 on a Parquet table by its files: only files that hold a key of the source are rewritten.

    For keys that do not name a partition. One scan of the key columns alone (with the
    runtime filter that Spark makes of the source) looks up the file of every source key;
    those files are merged with the source and replaced, source rows of new keys
    come with them, and every other file stays as it is. Rows that repeat a key in the target
    all take the update; a NULL key matches nothing and is inserted. Creates the table when the
    folder does not exist yet. Returns the numbers of files in the table and rewritten.
    """
    keys = list(keys)
    source = latest_by(source, keys, source_order or [])
    if not path_exists(spark, path):
        w = source.write
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        return {"files": 0, "rewritten": 0}
    recover(spark, path)
    target = spark.read.parquet(path)
    source = written(source, "upsert-source")
    found = (target.select(*keys, file_name().alias("_file"))
             .join(source.select(*keys), keys, "left_semi").select("_file").distinct())
    hit = [r[0] for r in found.collect()]   # names of files, as many as the listing has
    rows = read_files(spark, path, hit) if hit else target.limit(0)
    replace_files(upsert(rows, source, keys, update_cols, source_order), path, hit, partition_by)
    return {"files": len(target.inputFiles()), "rewritten": len(hit)}
