"""SparkSession construction and the fixed clock used by every date-dependent operator."""

from __future__ import annotations

import datetime as _dt
import os
import tempfile

from pyspark.sql import SparkSession

# Fixed clock: the last event day of the test data. Every operator that the reference
# anchors on current_date() takes ``as_of`` explicitly instead, defaulting to this.
AS_OF = _dt.date(2024, 1, 30)

# Settings every job relies on for results (not only for speed).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # event_params -> map: a repeated key keeps one entry instead of failing the job
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "playmart") -> SparkSession:
    """Return the active session, or build a local one for tests and benchmarks.

    On a cluster the session already exists (spark-submit); we only pin the settings
    results depend on. ``spark.checkpoint.dir`` is read from the session and only set
    here when unset (local runs), to a fresh scratch folder.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        spark = active
    else:
        builder = SparkSession.builder.appName(app_name)
        if master:
            builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("PLAYMART_DRIVER_MEMORY", "8g"))
        for k, v in SESSION_CONF.items():
            builder = builder.config(k, v)
        if shuffle_partitions:
            builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        if "PLAYMART_CHECKPOINT_DIR" in os.environ:
            builder = builder.config("spark.checkpoint.dir", os.environ["PLAYMART_CHECKPOINT_DIR"])
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; a scratch one is made only in local mode with none configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="playmart-ckpt-"))
    return sc.getCheckpointDir()
