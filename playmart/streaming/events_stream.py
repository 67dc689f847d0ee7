"""Structured Streaming loads of the intraday GA4 export.

The reference refreshes today's events every 15 minutes by replacing today's partition with the
latest snapshot. As streams:

* T1 ``stream_flatten_events``: files landing in a folder are flattened with the same Column
  functions as the batch staging model and appended to a partitioned Parquet table
  (stateless; ``availableNow`` processes whatever has landed, then stops).
* T2 ``stream_snapshot_replace``: every landing is a full snapshot of a day so far, kept under
  ``event_date=/snapshot_ts=`` and published by a marker once complete (``sources.snapshots``). The stream
  watches the markers alone; the batch function reads the newest complete snapshot of the days they
  name (older snapshots, half-landed ones and other days are not opened) and publishes each as the
  table's next snapshot of that day, which readers see at once or not at all.

Both are restartable: progress lives in the checkpoint location, and T2's writes are idempotent
(a replayed batch finds its snapshots published).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playmart.operators.staging import EVENT_COLUMNS, flatten_events, tracked_event_filter
from playmart.sources import snapshots


def land_increments(raw: DataFrame, landing_dir: str, parts: int = 4) -> None:
    """Test harness: write raw export rows into ``landing_dir`` as ``parts`` successive
    increments (by time of day), the way an export lands files during the day."""
    hour = F.hour(F.timestamp_micros("event_timestamp"))
    bucket = F.least((hour * parts / 24).cast("int"), F.lit(parts - 1))
    tagged = raw.withColumn("_part", bucket)
    for i in range(parts):
        tagged.where(F.col("_part") == i).drop("_part").write.mode("append").parquet(landing_dir)


def stream_flatten_events(spark: SparkSession, landing_dir: str, schema: StructType, sink_dir: str,
                          checkpoint_dir: str, files_per_batch: int = 1) -> None:
    """Flatten landed raw events and append them to ``sink_dir`` (partitioned by event_date)."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing_dir)
    out = flatten_events(tracked_event_filter(src))
    q = (out.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir)
         .partitionBy("event_date").outputMode("append").trigger(availableNow=True).start(sink_dir))
    q.awaitTermination()


def land_snapshot(raw: DataFrame, landing_dir: str, snapshot_ts: str) -> None:
    """Land one full snapshot of the day(s) in ``raw`` (``snapshot_ts`` sorts by time) and publish it."""
    days = [r[0] for r in raw.select("event_date").distinct().collect()]  # one row per landed day
    snapshots.publish(raw, landing_dir, "event_date", {d: snapshot_ts for d in days})


def stream_snapshot_replace(spark: SparkSession, landing_dir: str, schema: StructType, table_dir: str,
                            checkpoint_dir: str, as_of: _dt.date | None = None, files_per_batch: int = 1000) -> None:
    """For every micro-batch, replace the days whose snapshots became complete by the newest of these.
    With ``as_of`` only that day's rows count, as in the batch model (S8)."""
    today = as_of and as_of.strftime("%Y%m%d")

    def replace(batch: DataFrame, _batch_id: int) -> None:
        days = [r[0] for r in batch.select("day").distinct().collect()]  # one row per touched day
        newest = snapshots.published(spark, landing_dir, [d for d in days if not today or d == today])
        if newest:
            full = snapshots.read_published(spark, landing_dir, "event_date", schema, newest)
            dated = {_dt.datetime.strptime(d, "%Y%m%d").date().isoformat(): v for d, v in newest.items()}
            snapshots.publish(flatten_events(tracked_event_filter(full)), table_dir, "event_date", dated,
                              cluster_by=("event_name", "user_pseudo_id"))

    src = (spark.readStream.schema(snapshots.MARKER_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
           .json(snapshots.markers(spark, landing_dir)))
    q = (src.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_events_table(spark: SparkSession, path: str) -> DataFrame:
    """The table of T1, or the newest complete snapshot of every day of T2's."""
    events = spark.read.parquet(path)
    if snapshots.published(spark, path):
        return snapshots.read_published(spark, path, "event_date", events.schema).select(*EVENT_COLUMNS)
    return events.select(*EVENT_COLUMNS)
