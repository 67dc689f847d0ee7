"""One row per player (the per-user lookups of P3 and A19): first touch, first spend, IAP value.

Every column is a mergeable aggregate, so the rows of two stretches of days combine without their events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.columns import IAP_EVENT_NAMES, iap_value_usd, is_iap_revenue_event

USER = "user_pseudo_id"
TOUCH_EVENTS = ("first_open", "new_player")
FACTS = ("touch", "first_spend", "iap_value_usd")


def player_facts(events: DataFrame) -> DataFrame:
    """Per user: least touch by (moment, day, country, source, version), so tied moments give one answer; day of
    the first monetised IAP event; sum of IAP values. One aggregate, combined in the map tasks."""
    touch = F.struct(
        "event_timestamp", F.col("event_date").alias("cohort_date"),
        F.coalesce("geo_country", F.lit("unknown")).alias("geo_country"),
        F.coalesce(F.nullif("traffic_source_source", F.lit("")), F.nullif("app_info_install_source", F.lit("")),
                   F.lit("unknown")).alias("acquisition_source"),
        F.coalesce("app_version", F.lit("unknown")).alias("app_version"))
    value = F.when(F.col("event_name").isin(*IAP_EVENT_NAMES), iap_value_usd()).otherwise(F.lit(0.0))
    return events.where(F.col(USER).isNotNull()).groupBy(USER).agg(
        F.min(F.when(F.col("event_name").isin(*TOUCH_EVENTS), touch)).alias("touch"),
        F.min(F.when(is_iap_revenue_event(), F.col("event_date"))).alias("first_spend"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("iap_value_usd"))


def merge_player_facts(before: DataFrame, after: DataFrame) -> DataFrame:
    """The facts of two disjoint stretches of days as one; a user may be in either or both."""
    new = after.select(USER, *(F.col(c).alias(f"_{c}") for c in FACTS))
    return before.join(new, USER, "full").select(
        USER, F.least("touch", "_touch").alias("touch"), F.least("first_spend", "_first_spend").alias("first_spend"),
        (F.coalesce("iap_value_usd", F.lit(0.0)) + F.coalesce("_iap_value_usd", F.lit(0.0))).alias("iap_value_usd"))


def spender_segment() -> Column:
    """'spender' for a player with a monetised IAP event on any day."""
    return F.when(F.col("first_spend").isNotNull(), F.lit("spender")).otherwise(F.lit("non_spender"))
