"""The daily build: raw feeds -> stg_events -> marts -> data-quality gate.

After the day's feeds have landed: staging first, by changed shards of the look-back and carried run state
(``staging_load``), then the player dimension (``players``), then every mart with its look-back (14 days; 44 for LTV) replaced by partition overwrite, then the models that are rebuilt in full, then the data tests, as one
Spark job: ``full=True`` rebuilds every table; otherwise each mart rewrites
only the partitions its incremental window produces. Every write is idempotent, so a failed or
repeated run is simply run again.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession

from playmart.functions.columns import require_pii_salt
from playmart.operators import analytics, marts, quality
from playmart.plans import players, staging_load
from playmart.plans.warehouse import Warehouse
from playmart.session import AS_OF
from playmart.sources import fixtures
from playmart.sources.sinks import insert_overwrite_partitions, register_table, write_table

# mart -> (builder(warehouse, incremental), partition column, clustering columns)
MARTS = {
    "ua_performance_daily": (lambda w, inc: marts.ua_performance_daily(w.stg_adjust, w.as_of, inc),
                             "date", ("app", "network", "country")),
    "engagement_daily": (lambda w, inc: marts.engagement_daily(w.stg_unity, w.as_of, inc),
                         "date", ("country", "platform")),
    "iap_arpdau_daily": (lambda w, inc: marts.iap_arpdau_daily(w.events_without_next, w.as_of, inc, w.players),
                         "date", ("geo_country", "app_version", "spender_segment")),
    "cohort_ltv_daily": (lambda w, inc: marts.cohort_ltv_daily(w.events_without_next, w.as_of, inc),
                         "cohort_date", ("geo_country", "app_version", "days_since_install")),
    "creative_performance_daily": (lambda w, inc: marts.creative_performance_daily(w.stg_meta_ad, w.as_of, inc),
                                   "date", ("account_id", "campaign_id")),
    "ua_funnel_daily": (lambda w, inc: marts.ua_funnel_daily(w.stg_adjust, w.as_of, inc),
                        "date", ("app", "network", "country")),
    "session_depth_daily": (lambda w, inc: marts.session_depth_daily(w.events_without_next, w.as_of, inc),
                            "date", ("platform", "app_version", "geo_country")),
    "tutorial_funnel_daily": (lambda w, inc: marts.tutorial_funnel_daily(w.events_without_next, w.as_of, inc),
                              "date", ("tutorial_id", "app_version", "geo_country")),
}

# models without a look-back, rebuilt in full from the marts or the events
FULL = {
    "overview_daily": lambda w, t: marts.overview_daily(t["ua_performance_daily"], t["engagement_daily"]),
    **{name: (lambda w, t, f=getattr(analytics, name): f(w.stg_events)) for name in (
        "avg_time_spent", "coins_balance", "coins_balance_level", "coins_earned_failed",
        "coins_earned_won", "coins_earned_won_count", "coins_failed_count", "completed_players", "fail_rate",
        "fail_reasons", "fails_count", "tries_count", "iap_ltv", "iap_overview", "level_start_per_user",
        "max_level_active_day", "retention_abandonment_rate")},
    "retention_cohorts": lambda w, t: analytics.retention_cohorts(w.events_without_next, w.players),
    **{name: (lambda w, t, f=getattr(analytics, name): f(w.stg_events, w.game_objects)) for name in (
        "boosters_usage", "earned_spent_analysis", "upgrades_level")},
    "upgrades_analysis": lambda w, t: analytics.upgrades_analysis(w.stg_events, w.level_upgrade_recommendations),
}


def gate(tables: dict, raw_adjust, as_of: _dt.date, measured: dict | None = None) -> list:
    """All declared tests as summary rows: the column checks as the writes observed them (one aggregate for a
    table that was not measured), one per grain, the business rules and the feed's freshness."""
    parts = quality.column_checks(tables, measured or {})
    parts += [quality.dq_unique_grain(tables[t], t, list(keys), sev) for t, keys, sev in quality.GRAIN_TESTS]
    ua, iap, ltv = (tables[k] for k in ("ua_performance_daily", "iap_arpdau_daily", "cohort_ltv_daily"))
    rules = {"dq_no_future_dates": quality.dq_no_future_dates({t: (tables[t], c) for t, c in quality.DATED_MARTS}, as_of),
             "dq_no_negative_revenue": quality.dq_no_negative_revenue(ua, iap, ltv),
             "dq_arpdau_consistent": quality.dq_arpdau_consistent(iap), "dq_ltv_elapsed": quality.dq_ltv_elapsed(ltv, as_of),
             "dq_source_freshness": quality.dq_source_freshness(raw_adjust, "adjust_report", "day", as_of).where("status = 'error'")}
    return parts + [quality.rows_as_summary(df, k, k.removeprefix("dq_")) for k, df in rules.items()]


def land_events(w: Warehouse, landing: str, full: bool) -> None:
    """The export's part: shards that are not there yet (all with ``full``) and the newest intraday snapshot."""
    from pyspark.sql import functions as F
    raw = fixtures.raw_ga4_events(w.table("events"), w.as_of)
    have = [] if full else [c.split("=", 1)[1] for c in staging_load.children(w.spark, landing) if "intraday" not in c]
    new = F.col("table_suffix").startswith("intraday")
    if not have:
        new = F.lit(True)
    else:
        days = [(w.as_of - _dt.timedelta(days=k)).strftime("%Y%m%d") for k in range(1, staging_load.LOOKBACK_DAYS + 1)]
        missing = [d for d in days if d not in have]
        new = new | F.col("table_suffix").isin(*missing) if missing else new
    write_table(raw.where(new), landing, partition_by=("table_suffix",), dynamic=True)


def run_daily(spark: SparkSession, sf_dir: str, out_dir: str, as_of: _dt.date = AS_OF,
              full: bool = False, check: bool = True, database: str | None = None) -> dict[str, str]:
    """Build every mart and model under ``out_dir`` and return {name: path}. With ``check`` all declared
    tests run and an ``error`` failure raises: column checks on the rows this run wrote, counted by the writes
    themselves (earlier partitions were checked when they were written), grain and rules on whole tables. With ``database`` every table is
    registered there (``quality.row_counts_by_day`` over ``sinks.catalog_tables`` then covers it)."""
    require_pii_salt(spark)
    w = Warehouse(spark, sf_dir, as_of, materialize=True)
    landing, staged = f"{out_dir.rstrip('/')}/_landing/events", f"{out_dir.rstrip('/')}/_staging"
    land_events(w, landing, full)
    measured = {"stg_events": staging_load.load(spark, landing, staged, as_of, full, quality.write_metrics("stg_events")).metrics}
    stored = staging_load.stored_events(spark, staged)
    dimension = players.load(spark, stored, f"{out_dir.rstrip('/')}/_players", as_of, full=full)
    w.use_events(staging_load.events_view(spark, staged), stored, dimension)
    paths = {}
    for name, (build, part, cluster) in MARTS.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        df = build(w, not full)
        if full:
            measured[name] = write_table(df, path, partition_by=(part,), cluster_by=cluster, metrics=quality.write_metrics(name))
        else:
            measured[name] = insert_overwrite_partitions(df, path, [part], cluster_by=cluster, metrics=quality.write_metrics(name))
        paths[name] = path
    tables = {name: spark.read.parquet(p) for name, p in paths.items()}
    for name, build in FULL.items():
        paths[name] = f"{out_dir.rstrip('/')}/{name}"
        measured[name] = write_table(build(w, tables), paths[name], metrics=quality.write_metrics(name))
        tables[name] = spark.read.parquet(paths[name])
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for name, path in paths.items():
            part = (MARTS[name][1],) if name in MARTS else ()
            register_table(spark, database, name, path, tables[name].schema, part)
    if check:
        quality.assert_clean(quality.dq_summary(gate(tables | {"stg_events": w.stg_events}, w.raw_adjust, as_of,
                                                      {t: m for t, m in measured.items() if m})))
    return paths
