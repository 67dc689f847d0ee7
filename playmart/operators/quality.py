"""Data-quality jobs.

Column checks return one summary row ``(check, table_name, column_name, severity, failures)``; where a table is
written they are observed by the write itself (``write_metrics``) and only grain and rules read it again.
Business-rule checks return the offending rows. Each check is a single aggregate or filter over
the table, so it runs as one distributed pass; ``dq_summary`` unions the summaries and
``assert_clean`` is the only action (it raises when an ``error`` check has failures).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.columns import safe_divide
from playmart.session import AS_OF

SUMMARY_COLS = ("check", "table_name", "column_name", "severity", "failures")


def _summary(df: DataFrame, check: str, table: str, column: str, severity: str, failed: Column) -> DataFrame:
    return df.agg(F.count_if(failed).alias("failures")).select(
        F.lit(check).alias("check"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit(severity).alias("severity"), F.col("failures").cast("bigint").alias("failures"))


def _where(cond: Column, where: str | Column | None) -> Column:
    if where is None:
        return cond
    w = F.expr(where) if isinstance(where, str) else where
    return cond & F.coalesce(w, F.lit(False))


def dq_not_null(df: DataFrame, table: str, column: str, where: str | Column | None = None,
                severity: str = "error") -> DataFrame:
    """Rows where ``column`` is NULL (optionally only rows matching ``where``)."""
    return _summary(df, "not_null", table, column, severity, _where(F.col(column).isNull(), where))


def dq_accepted_values(df: DataFrame, table: str, column: str, values: Iterable, where: str | Column | None = None,
                       severity: str = "error") -> DataFrame:
    """Rows whose non-NULL ``column`` is outside ``values``; NULL passes."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(*list(values))
    return _summary(df, "accepted_values", table, column, severity, _where(bad, where))


def dq_unique_grain(df: DataFrame, table: str, keys: list[str], severity: str = "error") -> DataFrame:
    """D3: number of key combinations that occur more than once (NULL is a key value)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("unique_grain").alias("check"), F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("column_name"), F.lit(severity).alias("severity"),
        F.col("failures").cast("bigint").alias("failures"))


def dq_accepted_range(df: DataFrame, table: str, column: str, min_value=None, max_value=None,
                      severity: str = "warn") -> DataFrame:
    """Rows outside [min_value, max_value]; NULL passes."""
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (c < F.lit(min_value))
    if max_value is not None:
        bad = bad | (c > F.lit(max_value))
    return _summary(df, "accepted_range", table, column, severity, F.coalesce(bad, F.lit(False)))


def dq_source_freshness(df: DataFrame, table: str, column: str, as_of: _dt.date = AS_OF,
                        warn_hours: int = 36, error_hours: int = 72) -> DataFrame:
    """Hours from the newest ``column`` value to ``as_of`` (midnight UTC) and the status:
    'error' beyond ``error_hours``, 'warn' beyond ``warn_hours``, else 'pass'."""
    g = df.agg(F.max(column).alias("max_loaded"))
    hours = F.timestamp_diff("HOUR", F.col("max_loaded").cast("timestamp_ntz"),
                             F.lit(_dt.datetime.combine(as_of, _dt.time())).cast("timestamp_ntz"))
    return g.select(F.lit(table).alias("table_name"), F.col("max_loaded").cast("date").alias("max_loaded"),
                    hours.alias("hours_since_load"),
                    F.when(hours.isNull() | (hours > error_hours), F.lit("error"))
                     .when(hours > warn_hours, F.lit("warn")).otherwise(F.lit("pass")).alias("status"))


def dq_no_future_dates(dated: Mapping[str, tuple[DataFrame, str]], as_of: _dt.date = AS_OF) -> DataFrame:
    """(model_name, offending_date) for every mart row dated after ``as_of``."""
    parts = [df.where(F.col(col) > F.lit(as_of)).select(F.lit(name).alias("model_name"),
                                                         F.col(col).alias("offending_date"))
             for name, (df, col) in dated.items()]
    return reduce(DataFrame.unionByName, parts)


def dq_no_negative_revenue(ua: DataFrame, iap: DataFrame, ltv: DataFrame) -> DataFrame:
    """(model_name, metric, value) for negative spend/revenue values."""
    checks = [(ua, "ua_performance_daily", "spend"), (ua, "ua_performance_daily", "revenue"),
              (iap, "iap_arpdau_daily", "iap_revenue"), (ltv, "cohort_ltv_daily", "iap_revenue")]
    parts = [df.where(F.col(m) < 0).select(F.lit(name).alias("model_name"), F.lit(m).alias("metric"),
                                           F.col(m).cast("double").alias("value"))
             for df, name, m in checks]
    return reduce(DataFrame.unionByName, parts)


def dq_arpdau_consistent(iap: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Rows whose stored arpdau_iap differs from iap_revenue / dau by more than ``tolerance``."""
    re = safe_divide(F.col("iap_revenue"), F.col("dau"))
    return iap.where(F.abs(F.coalesce(F.col("arpdau_iap"), F.lit(0.0)) - F.coalesce(re, F.lit(0.0))) > tolerance).select(
        "date", "geo_country", "app_version", "spender_segment", "arpdau_iap", re.alias("recomputed_arpdau_iap"))


def dq_ltv_elapsed(ltv: DataFrame, as_of: _dt.date = AS_OF) -> DataFrame:
    """LTV points whose calendar day has not fully elapsed."""
    day = F.date_add(F.col("cohort_date"), F.col("days_since_install").cast("int"))
    return ltv.where(day >= F.lit(as_of)).select("cohort_date", "days_since_install", day.alias("as_of_day"))


def rows_as_summary(df: DataFrame, check: str, table: str, severity: str = "error") -> DataFrame:
    """Count the offending rows of a business-rule check as one summary row."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(check).alias("check"), F.lit(table).alias("table_name"), F.lit("*").alias("column_name"),
        F.lit(severity).alias("severity"), "failures")


def table_checks(df: DataFrame, table: str, checks: list[tuple[str, str, str, Column]]) -> DataFrame:
    """Evaluate many column checks of one table in a single aggregate pass and return one summary
    row per check. ``checks`` holds (check, column, severity, failure condition)."""
    agg = df.agg(*[F.count_if(cond).alias(f"_f{i}") for i, (_, _, _, cond) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(chk).alias("check"), F.lit(table).alias("table_name"),
                              F.lit(col).alias("column_name"), F.lit(sev).alias("severity"),
                              F.col(f"_f{i}").cast("bigint").alias("failures"))
                     for i, (chk, col, sev, _) in enumerate(checks)])
    return agg.select(F.inline(rows))


def not_null_check(column: str, where: str | Column | None = None, severity: str = "error"):
    return ("not_null", column, severity, _where(F.col(column).isNull(), where))


def accepted_values_check(column: str, values: Iterable, where: str | Column | None = None, severity: str = "error"):
    bad = F.col(column).isNotNull() & ~F.col(column).isin(*list(values))
    return ("accepted_values", column, severity, _where(bad, where))


def accepted_range_check(column: str, min_value=None, max_value=None, severity: str = "warn"):
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (c < F.lit(min_value))
    if max_value is not None:
        bad = bad | (c > F.lit(max_value))
    return ("accepted_range", column, severity, F.coalesce(bad, F.lit(False)))


def declared_checks() -> dict[str, list]:
    """The declared column checks by table."""
    checks: dict[str, list] = {}
    for specs, make in ((NOT_NULL_TESTS, not_null_check), (ACCEPTED_VALUES_TESTS, accepted_values_check),
                        (RANGE_TESTS, accepted_range_check)):
        for table, *spec in specs:
            checks.setdefault(table, []).append(make(*spec))
    return checks


def write_metrics(table: str) -> dict[str, Column]:
    """The declared column checks of a table as aggregates to observe while it is written (``sinks.write_table``)."""
    return {f"_f{i}": F.count_if(cond) for i, (_, _, _, cond) in enumerate(declared_checks().get(table, ()))}


def column_checks(tables: Mapping[str, DataFrame], measured: Mapping[str, Mapping[str, int]]) -> list[DataFrame]:
    """Summary rows of the declared column checks. A table in ``measured`` has the counts that its write observed
    and is not read; any other is one aggregate."""
    declared = declared_checks()
    seen = [(chk, t, col, sev, int(measured[t][f"_f{i}"])) for t, checks in declared.items() if t in measured
            for i, (chk, col, sev, _) in enumerate(checks)]
    parts = [table_checks(tables[t], t, checks) for t, checks in declared.items() if t not in measured]
    if seen:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(seen, "check string, table_name string, column_name string, severity string, "
                                                 "failures bigint"))  # one row per declared check
    return parts


def dq_summary(parts: list[DataFrame]) -> DataFrame:
    """All check summaries in one frame."""
    return reduce(DataFrame.unionByName, [p.select(*SUMMARY_COLS) for p in parts])


def assert_clean(summary: DataFrame) -> list:
    """Raise if an ``error`` check failed; return the failing ``warn`` rows otherwise."""
    bad = summary.where(F.col("failures") > 0).collect()  # one row per check: bounded by the check list
    errors = [r for r in bad if r["severity"] == "error"]
    if errors:
        raise AssertionError(f"data-quality errors: {[tuple(r) for r in errors]}")
    return bad


DATE_COLUMNS = ("cohort_date", "date", "event_date")


def row_counts_by_day(tables: Mapping[str, DataFrame], as_of: _dt.date = AS_OF, days: int = 7) -> DataFrame:
    """Rows per day over the last ``days`` days for each table, on the alphabetically first
    of ``cohort_date``/``date``/``event_date`` it has; tables with none report one whole-table count
    with a NULL day."""
    parts = []
    for name, df in tables.items():
        col = next((c for c in sorted(DATE_COLUMNS) if c in df.columns), None)
        if col is None:
            parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), F.lit(None).cast("date").alias("day"), "row_count"))
        else:
            day = F.col(col).cast("date")
            parts.append(df.where(day >= F.date_sub(F.lit(as_of), days)).groupBy(day.alias("day")).agg(
                F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "day", "row_count"))
    return reduce(DataFrame.unionByName, parts)


# ---- the reference's declared tests, as data (table, column, ...) ----------------------------

CURRENCY = "event_name IN ('currency_spent', 'currency_earned')"
NOT_NULL_TESTS = (
    ("stg_events", "event_date", None), ("stg_events", "event_timestamp", None),
    ("stg_events", "event_name", None), ("stg_events", "user_first_touch_timestamp", None),
    ("stg_events", "app_version", None), ("stg_events", "amount", CURRENCY),
    ("stg_events", "currency_type", CURRENCY), ("stg_events", "price", "event_name = 'in_app_purchase'"),
    ("stg_events", "price_gems", "event_name = 'iap_purchase'"),
    ("ua_performance_daily", "date", None), ("ua_performance_daily", "app", None),
    ("engagement_daily", "date", None), ("engagement_daily", "country", None), ("engagement_daily", "platform", None),
    ("creative_performance_daily", "date", None), ("creative_performance_daily", "ad_id", None),
    ("ua_funnel_daily", "date", None),
    ("iap_arpdau_daily", "date", None), ("iap_arpdau_daily", "geo_country", None),
    ("iap_arpdau_daily", "app_version", None), ("iap_arpdau_daily", "spender_segment", None),
    ("cohort_ltv_daily", "cohort_date", None), ("cohort_ltv_daily", "days_since_install", None),
    ("cohort_ltv_daily", "geo_country", None), ("cohort_ltv_daily", "app_version", None),
    ("session_depth_daily", "date", None), ("session_depth_daily", "platform", None),
    ("session_depth_daily", "app_version", None), ("session_depth_daily", "geo_country", None),
    ("tutorial_funnel_daily", "date", None), ("tutorial_funnel_daily", "app_version", None),
    ("tutorial_funnel_daily", "geo_country", None), ("tutorial_funnel_daily", "platform", None),
    ("tutorial_funnel_daily", "tutorial_id", None),
    ("retention_cohorts", "cohort_date", None), ("overview_daily", "date", None),
)
SPENDER = ("spender", "non_spender")
ACCEPTED_VALUES_TESTS = (
    ("stg_events", "device_category", ("mobile", "tablet"), None),
    ("stg_events", "device_operating_system", ("Android", "iOS"), None),
    ("stg_events", "platform", ("ANDROID", "IOS"), None),
    ("stg_events", "currency_type", ("Gems", "Coins"), CURRENCY),
    ("iap_arpdau_daily", "spender_segment", SPENDER, None),
    ("retention_cohorts", "spender_segment", SPENDER, None),
)
GRAIN_TESTS = (
    ("ua_performance_daily", ("date", "app", "platform", "country", "network", "campaign", "campaign_id"), "error"),
    ("engagement_daily", ("date", "country", "platform"), "error"),
    ("creative_performance_daily", ("date", "account_id", "campaign_id", "adset_id", "ad_id"), "error"),
    ("ua_funnel_daily", ("date", "app", "platform", "country", "network", "campaign"), "error"),
    ("iap_arpdau_daily", ("date", "geo_country", "app_version", "spender_segment"), "error"),
    ("cohort_ltv_daily", ("cohort_date", "days_since_install", "geo_country", "app_version"), "error"),
    ("session_depth_daily", ("date", "platform", "app_version", "geo_country"), "error"),
    ("tutorial_funnel_daily", ("date", "app_version", "geo_country", "platform", "tutorial_id", "step_num"), "error"),
    ("overview_daily", ("date", "app", "platform", "country"), "warn"),
    ("retention_cohorts", ("cohort_date", "geo_country", "acquisition_source", "app_version", "spender_segment"), "error"),
)
RANGE_TESTS = (
    ("ua_performance_daily", "spend", 0, None, "warn"), ("ua_performance_daily", "installs", 0, None, "warn"),
    ("ua_performance_daily", "roas", 0, None, "warn"), ("ua_performance_daily", "arpdau", 0, None, "warn"),
    ("ua_performance_daily", "iap_share", 0, 1, "warn"), ("ua_performance_daily", "ad_share", 0, 1, "warn"),
    ("engagement_daily", "dau", 0, None, "warn"), ("engagement_daily", "d1_retention", 0, 1, "warn"),
    ("engagement_daily", "d7_retention", 0, 1, "warn"), ("engagement_daily", "d30_retention", 0, 1, "warn"),
    ("creative_performance_daily", "video_completion_rate", 0, 1, "warn"),
    ("ua_funnel_daily", "click_to_install_rate", 0, None, "warn"),
    ("iap_arpdau_daily", "dau", 0, None, "warn"), ("iap_arpdau_daily", "iap_revenue", 0, None, "warn"),
    ("cohort_ltv_daily", "days_since_install", 0, 30, "error"),
    ("cohort_ltv_daily", "cohort_size", 0, None, "warn"), ("cohort_ltv_daily", "iap_revenue", 0, None, "warn"),
    ("session_depth_daily", "sessions", 0, None, "warn"), ("tutorial_funnel_daily", "users", 0, None, "warn"),
    ("retention_cohorts", "cohort_size", 0, None, "warn"), ("retention_cohorts", "total_iap_value_usd", 0, None, "warn"),
)
DATED_MARTS = (
    ("ua_performance_daily", "date"), ("engagement_daily", "date"), ("creative_performance_daily", "date"),
    ("ua_funnel_daily", "date"), ("iap_arpdau_daily", "date"), ("session_depth_daily", "date"),
    ("tutorial_funnel_daily", "date"), ("cohort_ltv_daily", "cohort_date"),
)
