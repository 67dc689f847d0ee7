"""Staging loaded by day (S7, S8, S10-S13 with K3, K4): a manifest of shards and runs that carry state.

``load`` brings the staging tables under one folder up to a day:

* ``manifest``: one row per landed shard with the fingerprint of its files when it was last loaded. In a daily
  run only the shards of the look-back are listed, and of these only the ones that changed are opened.
* ``daily``, ``intraday``: flattened events by ``event_date``; a changed shard replaces its partition, the
  intraday snapshot replaces the one before.
* ``events``: filled levels and level runs by ``event_date``, for the days from the look-back on. The scan starts
  from ``state``: one row per user (level, level before it, run number) as of the day before, written once
  per day as a version of its own, so a run can be repeated.
* ``patches``: a run's next level may arrive on a later day than its rows. Stored rows know the next level only if
  it starts on their own day; (user, run, next level, day found) closes the one open run a user has at a
  day's end. Days that were loaded earlier are therefore neither read nor rewritten.

``events_view`` joins the two. Days are cut by ``event_date``; a shard's timestamps must lie in its own day.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.functions.scans import level_runs
from playmart.operators import staging
from playmart.session import AS_OF
from playmart.sources.sinks import write_table

LOOKBACK_DAYS = 2
USER, RUN = "user_pseudo_id", "level_run_id"
EVENT_KEYS = list(staging.EVENT_COLUMNS)
STATE = f"{USER} string, level_id long, previous_level_id long, {RUN} long"
PATCH = f"{USER} string, {RUN} long, next_level_id long, found_in date"
MANIFEST = "suffix string, files long, bytes long, newest long, loaded_for date"


@dataclass
class Load:
    """What a run did: the first day computed, the shards opened, those left as they were, what was observed."""
    start: _dt.date
    opened: list[str] = field(default_factory=list)
    unchanged: list[str] = field(default_factory=list)
    metrics: dict[str, int] = field(default_factory=dict)  # what the write of ``events`` observed


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path`` (none if it does not exist)."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def fingerprint(spark: SparkSession, shard: str) -> tuple[int, int, int] | None:
    """(files, bytes, newest change) of a landed shard, or None: file metadata only."""
    fs, p = _fs(spark, shard)
    if not fs.exists(p):
        return None
    files = [s for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", "."))]
    return (len(files), sum(s.getLen() for s in files), max(s.getModificationTime() for s in files)) if files else None


def _version(spark: SparkSession, path: str, prefix: str, at_most: str | None = None) -> str | None:
    names = [c.split("=", 1)[1] for c in children(spark, path) if c.startswith(f"{prefix}=")]
    names = [n for n in names if (at_most is None or n <= at_most) and _fs(spark, f"{path}/{prefix}={n}/_SUCCESS")[0].exists(
        _fs(spark, f"{path}/{prefix}={n}/_SUCCESS")[1])]
    return max(names, default=None)


def state_through(spark: SparkSession, out: str, day: _dt.date) -> DataFrame | None:
    """How every user stood at the end of ``day`` (its version must have been written)."""
    if f"through={day}" not in children(spark, f"{out}/state"):
        return None
    return spark.read.schema(STATE).parquet(f"{out}/state/through={day}")


def closing_state(runs: DataFrame, before: DataFrame | None, through: _dt.date) -> DataFrame:
    """One row per user: the last run of the rows up to ``through``, or what was known before."""
    last = runs.where(F.col("event_date") <= F.lit(through)).groupBy(USER).agg(
        F.max_by("level_id", RUN).alias("level_id"), F.max_by("previous_level_id", RUN).alias("previous_level_id"), F.max(RUN).alias(RUN))
    if before is None:
        return last
    old = before.select(USER, *(F.col(c).alias(f"_{c}") for c in ("level_id", "previous_level_id", RUN)))
    new = F.col(RUN).isNotNull()
    return last.join(old, USER, "full").select(USER, *(
        F.when(new, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in ("level_id", "previous_level_id", RUN)))


def found_next(runs: DataFrame, before: DataFrame | None) -> DataFrame:
    """(user, run, next level, day found) of the runs with rows on an earlier day than the next run's start."""
    starts = runs.groupBy(USER, RUN).agg(F.min("event_date").alias("found_in"), F.max("level_id").alias("next_level_id"))
    began = starts.select(USER, RUN, F.col("found_in").alias("_began"))
    nxt = starts.where(F.col(RUN) > 0).withColumn(RUN, F.col(RUN) - 1).join(began, [USER, RUN], "left")
    open_run = F.lit(False)
    if before is not None:
        nxt = nxt.join(before.select(USER, F.col(RUN).alias("_open")), USER, "left")
        open_run = F.coalesce(F.col(RUN) == F.col("_open"), F.lit(False))
    return nxt.where(open_run | (F.col("_began") < F.col("found_in"))).select(USER, RUN, "next_level_id", "found_in")


def load(spark: SparkSession, landing: str, out: str, as_of: _dt.date = AS_OF, full: bool = False,
         metrics: dict | None = None) -> Load:
    """Bring the staging tables under ``out`` up to ``as_of`` from the shards under ``landing``
    (folders ``table_suffix=YYYYMMDD`` and ``table_suffix=intraday_YYYYMMDD``).

    A daily run covers the look-back and the days since the last run; without a stored state before them, or with
    ``full``, all shards are loaded. Repeating a run gives the same tables."""
    day = lambda n: as_of + _dt.timedelta(days=n)
    latest = _version(spark, f"{out}/state", "through")
    start = min(day(-LOOKBACK_DAYS), _dt.date.fromisoformat(latest) + _dt.timedelta(days=1)) if latest else None
    before = None if full or start is None else state_through(spark, out, start - _dt.timedelta(days=1))
    known: dict[str, tuple] = {}
    version = _version(spark, f"{out}/manifest", "as_of")
    if before is None:
        shards = [c.split("=", 1)[1] for c in children(spark, landing) if c.startswith("table_suffix=")]
        shards = [s for s in shards if s.isdigit() and s <= staging._suffix(day(-1))]
        start = min((_dt.datetime.strptime(s, "%Y%m%d").date() for s in shards), default=day(-LOOKBACK_DAYS))
    else:
        known = {r.suffix: (r.files, r.bytes, r.newest) for r in
                 spark.read.schema(MANIFEST).parquet(f"{out}/manifest/as_of={version}").collect()}  # one row per shard
        shards = [staging._suffix(start + _dt.timedelta(days=k)) for k in range((as_of - start).days)]
    prints = {s: p for s in shards if (p := fingerprint(spark, f"{landing}/table_suffix={s}"))}
    done = Load(start, [s for s in prints if prints[s] != known.get(s)], [s for s in prints if prints[s] == known.get(s)])

    def landed(suffixes):
        return spark.read.option("basePath", landing).parquet(*(f"{landing}/table_suffix={s}" for s in suffixes))

    if done.opened:
        flat = staging.flatten_events(staging.tracked_event_filter(landed(done.opened)))
        write_table(flat, f"{out}/daily", partition_by=("event_date",), dynamic=before is not None)
    daily = _between(spark, f"{out}/daily", start, as_of)
    snapshot = f"intraday_{staging._suffix(as_of)}"
    if fingerprint(spark, f"{landing}/table_suffix={snapshot}"):
        done.opened.append(snapshot)
        flat = staging.flatten_events(staging.tracked_event_filter(landed([snapshot]).where(F.col("event_date") == staging._suffix(as_of))))
        write_table(flat, f"{out}/intraday", partition_by=("event_date",))
        intraday = _between(spark, f"{out}/intraday", as_of, as_of)
        rows = intraday if daily is None else daily if intraday is None else staging.stg_events_union(
            daily, intraday, daily.where(F.col("event_date") == F.lit(as_of)))
    else:
        rows = daily
    if rows is None:
        return done
    runs = level_runs(rows.where(F.col(USER).isNotNull()).select(*EVENT_KEYS), state=before, next_at="_next_at", over=EVENT_KEYS)
    own_day = F.when(F.to_date("_next_at") == F.col("event_date"), F.col("next_level_id"))
    stored = runs.withColumn("next_level_id", own_day).select(*EVENT_KEYS, "previous_level_id", "next_level_id", RUN)
    done.metrics = write_table(stored, f"{out}/events", partition_by=("event_date",), cluster_by=("event_name", USER),
                               dynamic=before is not None, metrics=metrics)
    # what follows reads narrow columns of the days just written
    runs = _between(spark, f"{out}/events", start, as_of).select(USER, "event_date", "level_id", "previous_level_id", RUN)
    days = spark.createDataFrame([(start + _dt.timedelta(days=k),) for k in range((as_of - start).days + 1)], "found_in date")
    marks = days.select(F.lit(None).cast("string").alias(USER), F.lit(None).cast("long").alias(RUN),
                        F.lit(None).cast("long").alias("next_level_id"), "found_in")  # so that a day without patches is replaced too
    write_table(found_next(runs, before).unionByName(marks), f"{out}/patches", partition_by=("found_in",), dynamic=before is not None)
    for through in (day(-LOOKBACK_DAYS - 1), day(-LOOKBACK_DAYS)):
        if before is None or through >= start:
            write_table(closing_state(runs, before, through), f"{out}/state/through={through}")
    kept = {k: (*v, None) for k, v in known.items()} | {k: (*v, as_of) for k, v in prints.items()}
    rows = [(k, *v[:3], v[3] or as_of) for k, v in sorted(kept.items())]
    write_table(spark.createDataFrame(rows, MANIFEST).coalesce(1), f"{out}/manifest/as_of={as_of}")
    return done


def _between(spark: SparkSession, path: str, first: _dt.date, last: _dt.date) -> DataFrame | None:
    """The partitions of the days given that exist; no other folder is opened."""
    days = [f"event_date={first + _dt.timedelta(days=k)}" for k in range((last - first).days + 1)]
    have = [d for d in days if _fs(spark, f"{path}/{d}")[0].exists(_fs(spark, f"{path}/{d}")[1])]
    return spark.read.option("basePath", path).parquet(*(f"{path}/{d}" for d in have)) if have else None


def stored_events(spark: SparkSession, out: str) -> DataFrame:
    """The stored rows alone, for models that do not use ``next_level_id`` (86 columns): no patches are joined."""
    return spark.read.parquet(f"{out}/events").select(*EVENT_KEYS, "previous_level_id")


def events_view(spark: SparkSession, out: str) -> DataFrame:
    """S13 as loaded by day: the stored rows, open runs closed by the patches (87 columns)."""
    events = spark.read.parquet(f"{out}/events")
    patches = spark.read.schema(PATCH).parquet(f"{out}/patches").where(F.col(USER).isNotNull()).select(
        USER, RUN, F.col("next_level_id").alias("_next"), "found_in")
    later = F.when(F.col("event_date") < F.col("found_in"), F.col("_next"))
    return (events.join(patches, [USER, RUN], "left")
            .withColumn("next_level_id", F.coalesce("next_level_id", later))
            .select(*EVENT_KEYS, "previous_level_id", "next_level_id"))
