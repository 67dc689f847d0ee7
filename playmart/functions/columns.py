"""Column helpers shared by every layer. All of them are built-in Spark expressions,
so they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

import os

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's for right results ---------------------

# Game events kept out of the raw firehose (44 names, in the reference's order).
TRACKED_EVENT_NAMES = (
    "ad_impression", "ad_rewarded", "booster_used",
    "challenge_change_settings", "challenge_event", "challenge_quit",
    "challenge_resume", "challenge_returned_lost_customer", "challenge_time_added",
    "change_settings",
    "claim_all_mission_rewards", "claim_last_welcome_quest_reward",
    "claim_mission_reward", "claim_season_reward", "claim_welcome_quest_reward",
    "currency_earned", "currency_spent", "daily_reward_claimed",
    "delivery_dash_accept_order", "delivery_dash_collect_reward",
    "delivery_dash_get_new_orders", "delivery_dash_instant_finish",
    "delivery_dash_reject_order", "delivery_restock_food",
    "edit_profile_avatar", "edit_profile_name",
    "first_open", "game_started",
    "iap_purchase", "iap_purchase_failed", "in_app_purchase",
    "level_completed", "level_failed", "level_started",
    "new_player", "object_level_purchase", "refresh_quest",
    "screen_change", "screen_view", "session_start",
    "staff_level_purchase", "tutorial_completed", "tutorial_step",
    "user_engagement",
)

# Events that represent a monetised in-app purchase.
IAP_EVENT_NAMES = ("iap_purchase", "in_app_purchase")

# Salt for PII hashing: taken from the environment, with a marked non-production default.
PII_SALT_DEFAULT = "playmart-local-runs-only"

# Test traffic excluded by most models.
TEST_COUNTRY = "Croatia"

# Auto-fired noise events excluded from session depth.
NOISE_EVENTS = ("user_engagement", "screen_change", "screen_view")

# ----------------------------------------------------------------------------------------


def pii_salt() -> str:
    """The salt of the environment, else the marked default (as the reference's ``env_var`` does), on any master.
    Jobs that publish tables ask for one with ``require_pii_salt``."""
    return os.environ.get("PLAYMART_PII_SALT", PII_SALT_DEFAULT)


def require_pii_salt(spark: SparkSession) -> None:
    """Refuse the default salt on a cluster: the daily build's tables are kept."""
    if "PLAYMART_PII_SALT" not in os.environ and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set PLAYMART_PII_SALT: account ids are not hashed with the default salt on a cluster")


def safe_divide(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(num.cast("double"), F.nullif(den, F.lit(0)).cast("double"))


def hash_pii(c: Column, salt: str | None = None) -> Column:
    """NULL-safe lowercase hex SHA-256 of ``cast(c as string) || salt``."""
    s = pii_salt() if salt is None else salt
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.sha2(F.concat(c.cast("string"), F.lit(s)), 256))


def iap_value_usd(value_usd: str | Column = "event_value_in_usd",
                  price_dollars: str | Column = "price_dollars") -> Column:
    """USD value of a purchase: reconciled USD value, else client price, else 0. Never ``amount``."""
    return F.coalesce(_c(value_usd), _c(price_dollars), F.lit(0.0))


def is_iap_event(event_name: str | Column = "event_name") -> Column:
    return _c(event_name).isin(*IAP_EVENT_NAMES)


def is_iap_revenue_event(event_name: str | Column = "event_name",
                         value_usd: str | Column = "event_value_in_usd",
                         price_dollars: str | Column = "price_dollars") -> Column:
    """Monetised IAP event with a positive value."""
    return is_iap_event(event_name) & (iap_value_usd(value_usd, price_dollars) > 0)


def not_test_country(geo: str | Column = "geo_country") -> Column:
    """``geo != 'Croatia'`` with SQL three-valued logic: NULL geo is dropped too (reproduced on purpose)."""
    return _c(geo) != F.lit(TEST_COUNTRY)


def param(params: str | Column, key: str, value_type: str) -> Column:
    """Typed value of one key of an entity-attribute-value array; NULL when the key is absent.

    ``value_type`` is ``int``, ``double`` or ``string``. A key present twice yields the first
    entry (the source system errors instead); an empty or NULL array yields NULL.
    """
    hit = F.filter(_c(params), lambda x: x["key"] == F.lit(key))
    return F.get(hit, 0)["value"][f"{value_type}_value"]


def params_map(params: str | Column) -> Column:
    """The entity-attribute-value array as a map key -> value struct, built once per row.

    The array is reversed and the session keeps the last of repeated map keys
    (``spark.sql.mapKeyDedupPolicy=LAST_WIN``), so a repeated key resolves to its *first*
    entry, as ``param`` does. Lookups in the map are code-generated; a filter per key is a
    higher-order function Spark evaluates row by row without codegen."""
    return F.map_from_entries(F.reverse(_c(params)))


def map_param(m: Column, key: str, value_type: str) -> Column:
    """Typed value of ``key`` from a ``params_map``; NULL when absent."""
    return m[F.lit(key)][f"{value_type}_value"]


def action_value(actions: str | Column, action_type: str) -> Column:
    """Sum of ``value`` over the array elements with the given ``action_type``; NULL if none match."""
    hit = F.filter(_c(actions), lambda a: a["action_type"] == F.lit(action_type))
    return F.aggregate(hit, F.lit(None).cast("double"),
                       lambda acc, a: F.coalesce(acc, F.lit(0.0)) + a["value"].cast("double"))


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
