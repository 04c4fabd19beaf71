"""Landing-zone scans.

* Orders land hive-partitioned as ``year=/month=/day=`` (no zero padding);
  reading the root with ``basePath`` keeps the partition columns, so filters on
  them prune directories.
* Customers/products land as one ``snapshot_YYYYMMDD.parquet`` per day; the
  snapshot date comes from the file name (``_metadata``), so the newest
  snapshot wins the per-key dedupe and "as of" reads pick a snapshot.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from brightlake.session import list_names
from brightlake.sources.files import _path

SNAPSHOT_PATTERN = r"snapshot_(\d{8})"


def with_landing_order(raw: DataFrame) -> DataFrame:
    """Columns that say when a row landed, for batch and stream alike: file time, file path,
    row in the file."""
    return (raw.withColumn("_landed_at", F.col("_metadata.file_modification_time"))
            .withColumn("_landed_file", F.col("_metadata.file_path"))
            .withColumn("_landed_row", F.col("_metadata.row_index")))


def read_orders(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Explicit schema + partition columns, with the landing order used for
    "first landed wins"."""
    full = StructType(list(schema.fields) + [StructField(p, IntegerType(), True)
                                             for p in ("year", "month", "day")])
    return with_landing_order(spark.read.schema(full).option("basePath", root).parquet(root))


def generations(spark: SparkSession, root: str) -> dict[str, tuple[StructType, list[str]]]:
    """Schema generations below ``root``: schema -> its data folders (deliveries).

    Footers are read by Spark's schema merge, one delivery at a time: a delivery is one write,
    and evolution happens between deliveries. The driver holds folder names and schemas only.
    """
    found: dict[str, tuple[StructType, list[str]]] = {}
    files = spark.read.schema("x int").option("recursiveFileLookup", "true").parquet(root).inputFiles()
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        path = _path(spark, folder).toString()
        schema = spark.read.option("mergeSchema", "true").parquet(path).schema
        found.setdefault(schema.json(), (schema, []))[1].append(path)
    return found


def read_generations(spark: SparkSession, root: str, declared: StructType) -> DataFrame:
    """S1 over evolved files: every generation conformed to ``declared``, and the partition columns.

    A column that a generation lacks is NULL; one of another type is cast, and a value that does
    not fit (text that is no number, a number out of range) is NULL, never an error; columns
    that are not declared are left out. One scan a generation, with its own schema pushed to it.
    """
    parts = []
    for schema, folders in generations(spark, root).values():
        df = spark.read.schema(schema).option("basePath", root).parquet(*folders)
        own = set(schema.names)
        folder_columns = [c for c in df.columns if c not in own and c not in declared.names]
        parts.append(df.select(*[_conformed(f, schema) for f in declared], *folder_columns))
    if not parts:
        return spark.createDataFrame([], declared)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _conformed(field: StructField, schema: StructType):
    if field.name not in schema.names:
        return F.lit(None).cast(field.dataType).alias(field.name)
    column = F.col(f"`{field.name}`")
    if schema[field.name].dataType != field.dataType:
        column = column.try_cast(field.dataType)
    return column.alias(field.name)


def schema_drift(spark: SparkSession, root: str, declared: StructType) -> DataFrame:
    """Differences of the landed generations from ``declared``, a row a delivery and column:
    ``delivery, column_name, found_type, declared_type, change`` (missing, extra or retyped)."""
    rows = []
    for schema, folders in generations(spark, root).values():
        names = {f.name: f.dataType.simpleString() for f in schema}
        wanted = {f.name: f.dataType.simpleString() for f in declared}
        for name in sorted(names.keys() | wanted.keys()):
            a, b = names.get(name), wanted.get(name)
            if a != b:
                change = "missing" if a is None else "extra" if b is None else "retyped"
                rows += [(folder, name, a, b, change) for folder in folders]
    return spark.createDataFrame(rows, "delivery string, column_name string, found_type string, "
                                       "declared_type string, change string")


def snapshot_date_of(path_col="_metadata.file_path"):
    """Date in the snapshot's path (a file, or the folder Spark wrote); NULL if none."""
    text = F.regexp_extract(F.col(path_col), SNAPSHOT_PATTERN, 1)
    return F.try_to_date(F.nullif(text, F.lit("")), "yyyyMMdd")


def read_snapshots(spark: SparkSession, directory: str, schema: StructType | None = None) -> DataFrame:
    """Every snapshot file, tagged with its ``_snapshot`` date."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    df = r.option("recursiveFileLookup", "true").parquet(directory)
    return df.withColumn("_snapshot", snapshot_date_of())


def snapshot_files(spark: SparkSession, directory: str) -> list[tuple[str, str]]:
    """``(yyyyMMdd, path)`` of the snapshots in a folder by the listing alone, oldest first."""
    found = [(m[1], f"{directory.rstrip('/')}/{name}") for name in list_names(spark, directory)
             if (m := re.match(SNAPSHOT_PATTERN, name))]
    return sorted(found)


def list_snapshots(spark: SparkSession, directory: str, schema: StructType | None = None) -> DataFrame:
    """Snapshot dates with their row counts."""
    return (read_snapshots(spark, directory, schema)
            .groupBy(F.col("_snapshot").alias("snapshot_date"))
            .agg(F.count(F.lit(1)).alias("row_count")))


def read_as_of(spark: SparkSession, directory: str, as_of, schema: StructType | None = None) -> DataFrame:
    """The newest snapshot dated at or before ``as_of`` (empty if none).

    The snapshot is chosen from the folder's listing, so only its files are opened.
    """
    day = str(as_of)[:10].replace("-", "")
    files = snapshot_files(spark, directory)
    known = [path for date, path in files if date <= day]
    r = spark.read.schema(schema) if schema is not None else spark.read
    if not known:
        empty = r.parquet(files[-1][1]) if files else r.parquet(directory)
        return empty.limit(0)
    return r.parquet(known[-1])
