"""The player dimension: ``operators.players`` facts kept up to date by day, one row per user.

* ``through=D`` holds the facts of all events up to the day D, which no look-back reaches any more. A run takes the
  newest such version that is old enough, adds the days since and writes the version its own day allows; a run
  that is repeated, or follows after missed days, therefore gives the same rows.
* ``as_of=D`` adds the look-back days and the day itself; models read this one.

Both are bucketed and sorted by user, so neither the upsert nor a model's join shuffles the stored rows: only the few
days of new facts and the model's own side move. The bucket count is part of the path; another count starts
from all events again. The catalog holds the bucketing, so versions are registered in ``database`` when opened.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playmart.operators.players import USER, merge_player_facts, player_facts
from playmart.plans.staging_load import LOOKBACK_DAYS, _fs, _version, children
from playmart.session import AS_OF

BUCKETS = 64  # a cluster sets this near (players x 100 bytes) / 128 MB
KEEP = 3  # closed versions that stay for a run with an earlier day


def _name(database: str) -> str:
    return f"`{database}`.`players_{uuid.uuid4().hex[:12]}`"


def _open(spark: SparkSession, path: str, schema: StructType, buckets: int, database: str) -> DataFrame:
    table, columns = _name(database), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({USER}) SORTED BY ({USER}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def _store(facts: DataFrame, path: str, buckets: int, database: str) -> DataFrame:
    """Write a version. ``facts`` is spread by user over ``buckets`` partitions, so each task writes its bucket's file."""
    table = _name(database)
    (facts.write.format("parquet").bucketBy(buckets, USER).sortBy(USER).option("path", path)
     .mode("overwrite").saveAsTable(table))
    return facts.sparkSession.table(table)


def _drop(spark: SparkSession, root: str, versions) -> None:
    for v in versions:
        fs, p = _fs(spark, f"{root}/{v}")
        fs.delete(p, True)


def load(spark: SparkSession, events: DataFrame, out: str, as_of: _dt.date = AS_OF, database: str = "default",
         buckets: int = BUCKETS, full: bool = False) -> DataFrame:
    """Bring the dimension under ``out`` up to ``as_of`` and return it. ``events`` is partitioned by
    ``event_date``; of it only the days after the stored version are read (all of them without one, or with ``full``)."""
    root = f"{out.rstrip('/')}/buckets={buckets}"
    closed = as_of - _dt.timedelta(days=LOOKBACK_DAYS + 1)
    stored = [c for c in children(spark, root) if c.startswith("through=")]
    if full:
        _drop(spark, root, stored)
        stored = []
    base = _version(spark, root, "through", at_most=str(closed)) if stored else None

    def facts(after: _dt.date | None, last: _dt.date) -> DataFrame:
        days = F.col("event_date") <= F.lit(last)
        if after is not None:
            days = days & (F.col("event_date") > F.lit(after))
        return player_facts(events.where(days)).repartition(buckets, USER)

    state = None if base is None else _open(
        spark, f"{root}/through={base}", player_facts(events).schema, buckets, database)
    if base != str(closed):
        new = facts(base and _dt.date.fromisoformat(base), closed)
        state = _store(new if state is None else merge_player_facts(state, new), f"{root}/through={closed}", buckets, database)
        _drop(spark, root, sorted(c for c in stored if c < f"through={closed}")[:-KEEP])
    return _store(merge_player_facts(state, facts(closed, as_of)), f"{root}/as_of={as_of}", buckets, database)
