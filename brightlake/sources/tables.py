"""Named table scans over a folder of ``<name>.parquet`` tables (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Scan one table; Catalyst prunes columns and pushes filters into the reader."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session's catalog (S3)."""
    return spark.table(name)


def any_table(spark: SparkSession, name: str, jdbc: dict | None = None) -> DataFrame:
    """A table by name; with ``jdbc`` options (``url`` and others) from that database."""
    if jdbc:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    return spark.table(name)
