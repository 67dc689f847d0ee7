"""One object per input directory that wires raw feeds -> staging -> marts lazily.

Nothing here runs an action: every property is a lazy DataFrame whose plan Catalyst optimises
end to end (column pruning reaches the Parquet scans). ``materialize_events()`` cuts the
lineage of the one expensive shared table, ``stg_events``, by writing it as a Parquet table
partitioned by ``event_date`` under the shared checkpoint folder, as the reference does with
its table materialisation; later models then read it with partition pruning.
"""

from __future__ import annotations

import datetime as _dt
import threading
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from playmart.session import AS_OF, ensure_checkpoint_dir
from playmart.sources import fixtures
from playmart.sources.tables import read_table
from playmart.operators import staging


class Warehouse:
    _shared: dict = {}
    _shared_lock = threading.Lock()

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF,
                 materialize: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.materialize = materialize
        self._events_override: DataFrame | None = None
        self._without_next: DataFrame | None = None
        self.players: DataFrame | None = None
        self.measured: dict[str, dict] = {}  # counts of the declared column checks by table, from the writes
        self._lock = threading.RLock()
        self._database: str | None = None
        self._unlisted: list[tuple] = []  # built tables that the catalog does not list yet
        self.listed: set[str] = set()  # names that this warehouse has put into its database
        self._paths: list[str] = []  # of the tables built here

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF) -> "Warehouse":
        """One warehouse per (application, input dir, as_of) whose ``stg_events`` is written once
        as a table and then read by every model, like the reference's table materialisation.
        Where the shared folder has been emptied since, a new one builds its tables again."""
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), as_of)
        with cls._shared_lock:
            w = cls._shared.get(key)
            if w is None or not w.complete():
                w = cls._shared[key] = cls(spark, sf_dir, as_of, materialize=True)
            return w

    def complete(self) -> bool:
        """Whether every table built here is still in the shared folder."""
        from playmart.plans.staging_load import _fs
        for path in list(self._paths):
            fs, p = _fs(self.spark, path)
            if not fs.exists(p) or not len(fs.listStatus(p)):
                return False
        return True

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ---- raw feeds -------------------------------------------------------------------------
    def _landed(self, name: str, build, partition_by=(), finish=None) -> DataFrame:
        """A raw feed. When materialising it is landed once as a Parquet table (as the real
        exports are stored tables) and read back, so every model scans stored columns instead of
        re-deriving the feed; otherwise it is the lazy derivation. ``finish`` widens the rows once they are dealt
        to partitions."""
        if not self.materialize:
            return finish(build()) if finish else build()
        return self.model_table(f"raw_{name}", build, partition_by=partition_by, register=False, finish=finish)

    @cached_property
    def raw_events(self) -> DataFrame:
        """GA4 export, date-sharded: partitioned by ``table_suffix`` so shard filters prune files."""
        return self._landed("events", lambda: fixtures.raw_ga4_events(self.table("events"), self.as_of),
                            partition_by=("table_suffix",))

    @cached_property
    def raw_adjust(self) -> DataFrame:
        t = self.table
        return self._landed("adjust", lambda: fixtures.adjust_rows(
            t("lineitem"), t("orders"), t("customer"), t("nation"), t("region")), partition_by=("day",),
            finish=fixtures.adjust_columns)

    @cached_property
    def raw_unity(self) -> DataFrame:
        t = self.table
        return self._landed("unity", lambda: fixtures.unity_analytics_daily(
            t("orders"), t("customer"), t("nation"), t("region")), partition_by=("day",))

    @cached_property
    def raw_meta_ad(self) -> DataFrame:
        return self._landed("meta_ad", lambda: fixtures.meta_ads_ad_daily(self.table("lineitem")),
                            partition_by=("date_start",))

    @cached_property
    def raw_meta_campaign(self) -> DataFrame:
        return self._landed("meta_campaign", lambda: fixtures.meta_ads_campaign_daily(self.table("lineitem")),
                            partition_by=("date_start",))

    @cached_property
    def game_objects(self) -> DataFrame:
        return fixtures.game_objects(self.table("part"))

    @cached_property
    def level_upgrade_recommendations(self) -> DataFrame:
        return fixtures.level_upgrade_recommendations(self.table("part"))

    # ---- staging ---------------------------------------------------------------------------
    @cached_property
    def stg_events_daily(self) -> DataFrame:
        return staging.stg_events_daily(self.raw_events, self.as_of)

    @cached_property
    def stg_events_intraday(self) -> DataFrame:
        return staging.stg_events_intraday(self.raw_events, self.as_of)

    @property
    def stg_events(self) -> DataFrame:
        if self._events_override is None and self.materialize:
            with self._lock:
                if self._events_override is None:
                    self.materialize_events()
        if self._events_override is not None:
            return self._events_override
        return self._stg_events_lazy

    @cached_property
    def stg_events_union(self) -> DataFrame:
        return staging.stg_events_union(self.stg_events_daily, self.stg_events_intraday,
                                        staging.finalized_on(self.raw_events, self.as_of))

    @cached_property
    def _stg_events_lazy(self) -> DataFrame:
        return staging.stg_events(self.stg_events_union)

    def _scratch(self, name: str) -> str:
        return f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"

    def _write_and_read(self, df: DataFrame, path: str, partition_by=(), cluster_by=(), name: str | None = None,
                        finish=None) -> DataFrame:
        """With ``name`` the declared column checks of that table are observed while it is written."""
        from playmart.operators.quality import write_metrics
        from playmart.sources.sinks import write_table
        seen = write_table(df, path, partition_by=partition_by, cluster_by=cluster_by, metrics=write_metrics(name) if name else None, finish=finish)
        if seen:
            self.measured[name] = seen
        self._paths.append(path)
        df = finish(df) if finish else df
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def materialize_events(self, path: str | None = None) -> str:
        """Build ``stg_events`` the way the reference schedules it: the flattened daily and
        intraday shards are written as a table partitioned by event_date, the fill/run scans read
        that table (so the scan plan's narrow re-reads touch 3-4 flat columns instead of decoding
        the nested params array of the raw export each time), and the result is written once more,
        clustered by event name and user. Returns the stg_events table path."""
        union = self._write_and_read(self.stg_events_union, self._scratch("stg_events_union"),
                                     partition_by=("event_date",))
        path = path or self._scratch("stg_events")
        self._events_override = self._write_and_read(staging.stg_events(union), path, partition_by=("event_date",),
                                                     cluster_by=("event_name", "user_pseudo_id"), name="stg_events")
        self._register("stg_events", path, self._events_override, ("event_date",))
        return path

    def use_events(self, events: DataFrame, without_next: DataFrame | None = None, players: DataFrame | None = None) -> None:
        """Take ``stg_events`` from a table that a load keeps up to date, with its plain rows for models that do
        not use ``next_level_id`` and the player dimension for those that look users up."""
        self._events_override, self._without_next, self.players = events, without_next, players

    @property
    def events_without_next(self) -> DataFrame:
        return self.stg_events if self._without_next is None else self._without_next

    @property
    def database(self) -> str:
        """The catalog database that lists the tables built here, brought up to date when it is asked for: models
        read their tables by path, so they run where the catalog may not be written."""
        from playmart.sources.sinks import register_table
        with self._lock:
            if self._database is None:
                name = f"playmart_{uuid.uuid4().hex[:8]}"
                self.spark.sql(f"CREATE DATABASE `{name}` LOCATION '{self._scratch(name)}'")
                self._database = name
            while self._unlisted:
                register_table(self.spark, self._database, *self._unlisted[0])
                self.listed.add(self._unlisted.pop(0)[0])
        return self._database

    def catalog(self) -> dict[str, DataFrame]:
        """The tables built here as the catalog lists them; others in the database (versions of the player dimension)
        are left out."""
        from playmart.sources.sinks import catalog_tables
        return {n: t for n, t in catalog_tables(self.spark, self.database).items() if n in self.listed}

    def _register(self, name: str, path: str, df: DataFrame, partition_by=()) -> None:
        with self._lock:
            self._unlisted.append((name, path, df.schema, partition_by))

    def model_table(self, name: str, build, partition_by=(), register: bool = True, finish=None) -> DataFrame:
        """A table built once per warehouse when materialising (as the reference's tables are) and, with
        ``register``, listed in the catalog, else the lazy plan."""
        if not self.materialize:
            return build()
        cache = self.__dict__.setdefault("_models", {})
        with self._lock:
            if name not in cache:
                path = self._scratch(name)
                df = self._write_and_read(build(), path, partition_by=partition_by, name=name, finish=finish)
                if register:
                    self._register(name, path, df, partition_by)
                cache[name] = df
        return cache[name]

    @property
    def sessions(self) -> DataFrame:
        """P7, built once where tables are."""
        from playmart.operators import marts
        return self.model_table("sessions", lambda: marts.sessions(self.stg_events, self.as_of))

    @cached_property
    def stg_adjust(self) -> DataFrame:
        return staging.stg_adjust__report(self.raw_adjust)

    @cached_property
    def stg_unity(self) -> DataFrame:
        return staging.stg_unity__analytics_daily(self.raw_unity)

    @cached_property
    def stg_meta_ad(self) -> DataFrame:
        return staging.stg_meta_ads__ad_daily(self.raw_meta_ad)

    @cached_property
    def stg_meta_campaign(self) -> DataFrame:
        return staging.stg_meta_ads__campaign_daily(self.raw_meta_campaign)
