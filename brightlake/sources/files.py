"""Files of a written Parquet table: their listing, and replacing some of them.

Replacing files is not atomic on a plain folder, so it goes in three steps that can be run
again: the new files are written below a hidden folder of the table; a journal that names
every move and every file to go is put beside them; then the moves and deletions follow. A
crash before the journal leaves the old table, and one after it is carried on by
``recover``, which every function that replaces files calls first. The driver handles names
and sizes only, as many as the table's listing has.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightlake.session import _hadoop, delete_path, path_exists

JOURNAL = "_replaced.json"


def _path(spark: SparkSession, uri: str):
    """The Hadoop path of a URI as Spark names files (special characters are escaped)."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))


def table_files(spark: SparkSession, path: str) -> dict[str, int]:
    """URI -> bytes of every data file of the table, by the listing alone."""
    names = [re.sub("^file:/+", "file:/", n) for n in spark.read.parquet(path).inputFiles()]
    fs, _ = _hadoop(spark, path)
    sizes: dict[tuple[str, str], int] = {}
    for folder in {n.rsplit("/", 1)[0] for n in names}:
        for status in fs.listStatus(_path(spark, folder)):
            sizes[folder, status.getPath().getName()] = status.getLen()
    return {n: sizes[n.rsplit("/", 1)[0], _path(spark, n).getName()] for n in names}


def file_name():
    """The column that names a row's file, as ``table_files`` does."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")


def read_files(spark: SparkSession, path: str, files: Iterable[str]) -> DataFrame:
    """Rows of some of the table's files, with its partition columns."""
    return spark.read.schema(spark.read.parquet(path).schema).option("basePath", path).parquet(
        *[_path(spark, f).toString() for f in files])


def replace_files(df: DataFrame, path: str, old: Iterable[str], partition_by=(),
                  drop: str | None = None) -> list[str]:
    """Write ``df`` into the table in the place of its files ``old``; returns the new files.

    ``df`` may read the files that it replaces. Other files keep their bytes and times.
    ``drop`` names a partition column that only deals rows to files, the last one; its value goes
    into the names of the files, which a task that writes several values would repeat.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}/_staged_{uuid.uuid4().hex[:12]}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(staged)
    fs, root = _hadoop(spark, staged)
    top = fs.makeQualified(root).toString()
    moves, found = [], fs.listFiles(root, True)
    while found.hasNext():
        at = found.next().getPath()
        if at.getName().endswith(".parquet"):
            name = at.toString()[len(top) + 1:]
            if drop:
                name = re.sub(f"(^|/){drop}=([^/]*)/", r"\1bin-\2-", name)
            moves.append([at.toString(), f"{path.rstrip('/')}/{name}"])
    _write_journal(spark, path, {"staged": staged, "moves": moves,
                                 "old": [_path(spark, f).toString() for f in old]})
    recover(spark, path)
    return [to for _, to in moves]


def _write_journal(spark: SparkSession, path: str, plan: dict) -> None:
    """In one rename, so that a journal is whole or not there."""
    part = f"{path.rstrip('/')}/_part_{JOURNAL}"
    fs, p = _hadoop(spark, part)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(plan).encode()))
    out.close()
    fs.rename(p, _hadoop(spark, f"{path.rstrip('/')}/{JOURNAL}")[1])


def recover(spark: SparkSession, path: str) -> bool:
    """Carry on a replacement that stopped after its journal was written."""
    journal = f"{path.rstrip('/')}/{JOURNAL}"
    if not path_exists(spark, journal):
        return False
    fs, p = _hadoop(spark, journal)
    stream = fs.open(p)
    plan = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    for source, target in plan["moves"]:
        fs, src = _hadoop(spark, source)
        dst = _hadoop(spark, target)[1]
        if fs.exists(src):
            fs.mkdirs(dst.getParent())
            if not fs.rename(src, dst):
                raise OSError(f"{source} could not be renamed to {target}")
    for name in plan["old"]:
        delete_path(spark, name)
    delete_path(spark, plan["staged"])
    return delete_path(spark, journal)


def delete_files(spark: SparkSession, path: str, old: Iterable[str]) -> None:
    """Delete whole files of the table, as one replacement by nothing."""
    _write_journal(spark, path, {"staged": f"{path.rstrip('/')}/_staged_none", "moves": [],
                                 "old": [_path(spark, f).toString() for f in old]})
    recover(spark, path)


def pack(sizes: dict[str, int], limit: int) -> list[list[str]]:
    """First-fit decreasing: groups of names whose sizes add up to ``limit`` at most (a larger
    one stands alone)."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        for i, (used, names) in enumerate(bins):
            if used + size <= limit:
                names.append(name)
                bins[i] = (used + size, names)
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins]
