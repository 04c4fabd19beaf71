"""Session helpers.

Library code never sets ``master``; only tests and the bench build a local
session. Checkpoints and scratch tables go to the shared folder named by
``spark.checkpoint.dir``. Where that is unset, a machine-local folder is used
for a ``local[...]`` master only, whose one process sees it; on a cluster the
setting is required.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

_scratch: list[str] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "brightlake", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used by library code)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; raises on a cluster that names none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="brightlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders handed out so far; call it when their results are used up."""
    n = 0
    while _scratch:
        n += delete_path(spark, _scratch.pop())
    return n


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return bool(fs.delete(p, True))


def replace_path(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``. The old folder is set aside first and
    deleted last, so a crash in between leaves it whole beside the table."""
    fs, p = _hadoop(spark, path)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    aside = path_of(f"{path.rstrip('/')}__old_{uuid.uuid4().hex[:12]}")
    had = fs.exists(p)
    if had and not fs.rename(p, aside):
        raise OSError(f"{path} could not be renamed to {aside}")
    if not fs.rename(path_of(new), p):
        if had:
            fs.rename(aside, p)
        raise OSError(f"{new} could not be renamed to {path}")
    if had:
        fs.delete(aside, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder; the folders above ``to`` are made, and ``to`` must not be there."""
    fs, p = _hadoop(spark, path)
    target = _hadoop(spark, to)[1]
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(p, target):
        raise OSError(f"{path} could not be renamed to {to}")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly below ``path``."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders whose path matches ``pattern``, in order."""
    fs, p = _hadoop(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss; never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written scratch table: lineage is cut, and readers prune its columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


__all__ = ["local_session", "ensure_checkpoint_dir", "scratch_path", "release_scratch",
           "path_exists", "delete_path", "move_path", "replace_path", "list_names", "glob_paths", "cut_lineage", "written"]
