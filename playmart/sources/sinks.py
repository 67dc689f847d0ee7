"""Sinks and incremental loads (K1-K6)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_view(df: DataFrame, name: str) -> DataFrame:
    """K1: a view is a lazy DataFrame registered under a name; nothing is computed."""
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                cluster_by: Sequence[str] = (), mode: str = "overwrite", dynamic: bool = False,
                metrics: Mapping[str, Column] | None = None,
                finish: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, int]:
    """K2/K5: full rebuild of a Parquet table.

    ``metrics`` are aggregates over the written rows, taken by the writing tasks themselves: the table need not be
    read again for them. They are observed in the write's last stage, whose tasks count once however often
    one is retried.

    ``cluster_by`` sorts rows inside each file (no extra shuffle) so Parquet row-group min/max
    statistics let later scans skip on those columns, the analogue of warehouse clustering.
    With ``partition_by`` the rows are rebalanced on the partition columns: AQE groups each
    date into few tasks (few files per partition) but splits a large date into advisory-size
    chunks, so one day of data never lands in a single task.

    ``finish`` is a projection that keeps the partition columns: it widens the rows after they are exchanged and
    sorted, so neither handles the wide ones.
    """
    out = df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    seen = Observation()
    if metrics:
        out = out.observe(seen, *(c.alias(n) for n, c in metrics.items()))  # below the sort, whose order the write keeps
    if partition_by or cluster_by:
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    # an option of this one write: other writers of the session keep their own mode
    if finish:
        out = finish(out)
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if not metrics:
        return {}
    got = seen._jo.getOrEmpty() if seen._jo is not None else None
    if got is not None and got.nonEmpty():
        return dict(seen.get)
    # a plan known to be empty is optimised away with its metrics
    return df.agg(*(c.alias(n) for n, c in metrics.items())).first().asDict()


def register_table(spark: SparkSession, database: str, name: str, path: str, schema: StructType,
                   partition_by: Sequence[str] = ()) -> None:
    """K2 in the catalog: ``database.name`` names the Parquet files under ``path``. The table is external, so
    replacing the name leaves the files; registering again takes up partitions and columns that came since."""
    table = f"`{database}`.`{name}`"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)}) " if partition_by else ""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts}LOCATION '{path}'")
    if partition_by:
        spark.catalog.recoverPartitions(table)


def catalog_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The tables of a database by name; views are left out."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if t.tableType in ("EXTERNAL", "MANAGED"))
    return {n: spark.table(f"`{database}`.`{n}`") for n in names}


def insert_overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                                cluster_by: Sequence[str] = (), metrics: Mapping[str, Column] | None = None) -> dict[str, int]:
    """K3: replace only the partitions present in ``df``; all other partitions stay as they are.

    Idempotent: running the same batch twice leaves the same table. A partition whose rows all
    vanished from the new batch is not touched (it stays stale), like the reference's strategy.
    """
    return write_table(df, path, partition_by=partition_by, cluster_by=cluster_by, dynamic=True, metrics=metrics)


def incremental_window(df: DataFrame, date_col: str, as_of: _dt.date, days: int,
                       incremental: bool) -> DataFrame:
    """K4: in incremental mode keep rows with ``date_col >= as_of - days`` (a partition filter
    when ``date_col`` is the table's partition column); in full mode keep everything."""
    if not incremental:
        return df
    return df.where(F.col(date_col) >= F.date_sub(F.lit(as_of), days))


def append_new_columns(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """K6: load partitions that may have more columns than the table's older ones.

    The same partition overwrite as K3, so a second run of the batch leaves the same table."""
    insert_overwrite_partitions(df, path, partition_by)


def read_evolving(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a table with its current ``schema``; partitions written before a column existed give NULL.

    The schema is declared, so no file footers are read to merge one."""
    return spark.read.schema(schema).parquet(path)
