"""Whole snapshots of a day, seen only when complete.

Layout: ``<date column>=D/snapshot_ts=T/`` holds one full snapshot of the day D, ``_published/D@T.json`` says that it
is complete. The marker is made after the write has been committed, by a rename, so

* a half-landed snapshot is not there for anybody, whatever its time;
* readers choose folders by markers: a day passes from one whole snapshot to the next at once, and a reader that
  chose before keeps its files until ``retire`` removes them;
* a write that failed is simply repeated: an unpublished folder is replaced, a published one is never touched.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

VERSION = "snapshot_ts"
MARKER_SCHEMA = "day string, snapshot_ts string"


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def markers(spark: SparkSession, path: str) -> str:
    """The folder of markers, made if it is not there (a stream needs a folder to watch)."""
    fs, p = _fs(spark, f"{path}/_published")
    fs.mkdirs(p)
    return f"{path}/_published"


def _versions(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    fs, p = _fs(spark, f"{path}/_published")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return [tuple(map(unquote, n.removesuffix(".json").split("@"))) for n in names if n.endswith(".json") and n[0] not in "_."]


def published(spark: SparkSession, path: str, days: Iterable[str] | None = None) -> dict[str, str]:
    """{day: its newest complete snapshot}, from file names alone; ``days`` limits it."""
    wanted = None if days is None else set(days)
    newest: dict[str, str] = {}
    for day, version in _versions(spark, path):
        if (wanted is None or day in wanted) and version >= newest.get(day, version):
            newest[day] = version
    return newest


def _folder(spark: SparkSession, path: str, date_col: str, day: str, version: str) -> str:
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName  # as the write names it
    return f"{path}/{date_col}={name(day)}/{VERSION}={name(version)}"


def _mark(spark: SparkSession, path: str, day: str, version: str) -> None:
    folder = markers(spark, path)
    fs, part = _fs(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = fs.create(part)
    out.write(bytearray(json.dumps({"day": day, VERSION: version}).encode()))
    out.close()
    fs.rename(part, _fs(spark, f"{folder}/{quote(day, safe='-')}@{quote(version, safe='-')}.json")[1])


def publish(df: DataFrame, path: str, date_col: str, versions: dict[str, str], cluster_by=()) -> dict[str, str]:
    """Write the rows of each day of ``versions`` as that snapshot, then make them visible. Days whose snapshot is
    published already are left as they are; a day without rows becomes empty. Returns what was published."""
    from playmart.sources.sinks import write_table
    spark = df.sparkSession
    have = set(_versions(spark, path))
    new = {d: v for d, v in versions.items() if (d, v) not in have}
    if not new:
        return new
    day = F.col(date_col).cast("string")
    version = F.coalesce(*(F.when(day == d, F.lit(v)) for d, v in sorted(new.items())))
    rows = df.where(day.isin(*new)).withColumn(VERSION, version)
    write_table(rows, path, partition_by=(date_col, VERSION), cluster_by=cluster_by, dynamic=True)
    for d, v in sorted(new.items()):
        _mark(spark, path, d, v)
    return new


def read_published(spark: SparkSession, path: str, date_col: str, schema: StructType,
                   days: Iterable[str] | None = None) -> DataFrame:
    """The newest complete snapshot of each day (of ``days``): only these folders are opened."""
    folders = [_folder(spark, path, date_col, d, v) for d, v in sorted(published(spark, path, days).items())]
    folders = [f for f in folders if _exists(spark, f)]  # a day without rows has a marker only
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", path).schema(schema).parquet(*folders).select(*schema.names)


def retire(spark: SparkSession, path: str, date_col: str, keep: int = 1) -> int:
    """Remove the snapshots older than the newest ``keep`` of their day, marker first; unpublished ones stay."""
    by_day: dict[str, list[str]] = {}
    for day, version in _versions(spark, path):
        by_day.setdefault(day, []).append(version)
    gone = [(d, v) for d, vs in by_day.items() for v in sorted(vs)[:-max(keep, 1)]]
    for d, v in gone:
        for old in (f"{path}/_published/{quote(d, safe='-')}@{quote(v, safe='-')}.json", _folder(spark, path, date_col, d, v)):
            fs, p = _fs(spark, old)
            fs.delete(p, True)
    return len(gone)
