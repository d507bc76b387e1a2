"""Acquisition economics: CAC, LTV30, ROAS30 and the target blend."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fanpulse.functions.joins import join_validated, unique_by
from fanpulse.functions.scalar import safe_divide
from fanpulse.operators.windows import span_sums
from fanpulse.schemas import PAID_CHANNELS

# The campaign target sheet (channel, target spend, target CAC,
# target 30-day ROAS) for the whole period.
CAMPAIGN_TARGETS = [
    ("paid_search", 77040.0, 14.0, 1.10),
    ("social", 57780.0, 9.0, 1.20),
    ("partner", 33170.0, 15.0, 1.00),
]
TARGET_SCHEMA = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("target_spend_usd", T.DoubleType()),
    T.StructField("target_cac_usd", T.DoubleType()),
    T.StructField("target_roas_30d", T.DoubleType()),
])


def campaign_targets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CAMPAIGN_TARGETS, TARGET_SCHEMA)


def _daily_revenue(events: DataFrame) -> DataFrame:
    """Revenue per (user, day), so a heavy user has few rows. Zero revenue changes no sum: the filter reaches the scan."""
    return events.where(F.col("revenue_usd") != 0).groupBy("user_id", "event_date").agg(F.sum("revenue_usd").alias("_rev"))


def check_spend_grain(spend: DataFrame) -> None:
    """Raise if a (date, channel) has several spend rows: the user rollup is
    per (date, channel), so each such row would repeat its users and revenue."""
    from fanpulse.functions.joins import CardinalityError, duplicate_keys

    bad = duplicate_keys(spend.select("spend_date", "channel"), ["spend_date", "channel"]).limit(1).collect()
    if bad:
        raise CardinalityError(f"several spend rows per (spend_date, channel): {bad[0].asDict()}")


def unit_economics(
    users: DataFrame, events: DataFrame, spend: DataFrame, window_days: int = 30, validate_grain: bool = False
) -> DataFrame:
    """Per spend row (date, channel): spend, funnel counts, new users, 30-day
    revenue (signup day .. signup + 30 inclusive) and the ratios. Ratios use the
    un-coalesced user side, so they are NULL where no users joined.
    ``validate_grain`` first checks one spend row per (date, channel)."""
    if validate_grain:
        check_spend_grain(spend)
    acquired = users.where(F.col("acquisition_channel").isin(*PAID_CHANNELS)).select(
        "signup_date", F.col("acquisition_channel").alias("channel"), "user_id"
    )
    per_user = span_sums(acquired, _daily_revenue(events), "user_id", "signup_date", F.date_add("signup_date", window_days),
                         "event_date", "_rev", "_revenue").groupBy("signup_date", "channel", "user_id").agg(F.sum("_revenue").alias("revenue_30d"))
    rollup = per_user.groupBy("signup_date", "channel").agg(
        F.count("user_id").alias("new_users"), F.sum("revenue_30d").alias("u_revenue_30d")
    )
    s = spend.alias("s")
    j = s.join(
        rollup.alias("u"),
        (F.col("s.spend_date") == F.col("u.signup_date")) & (F.col("s.channel") == F.col("u.channel")),
        "left",
    )
    return j.select(
        F.col("s.spend_date").alias("metric_date"), F.col("s.channel").alias("channel"),
        "impressions", "clicks", "installs", F.col("spend_usd"),
        F.col("target_spend_usd"),
        F.coalesce("new_users", F.lit(0)).alias("new_users"),
        F.coalesce("u_revenue_30d", F.lit(0.0)).alias("revenue_30d"),
        safe_divide("spend_usd", "new_users").alias("cac_usd"),
        safe_divide("u_revenue_30d", "new_users").alias("ltv_30d_usd"),
        safe_divide("u_revenue_30d", "spend_usd").alias("roas_30d"),
        safe_divide("clicks", "impressions").alias("click_through_rate"),
        safe_divide("installs", "clicks").alias("click_to_install_rate"),
    )


def channel_economics(users: DataFrame, events: DataFrame, spend: DataFrame, window_days: int = 30) -> DataFrame:
    """Whole-period economics per paid channel (report form): counts every user
    of the channel and revenue from events 0..30 days after signup. Fails if a user id occurs twice."""
    totals = spend.groupBy("channel").agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
        F.sum("installs").alias("installs"), F.sum("spend_usd").alias("spend_usd"),
        F.sum("target_spend_usd").alias("target_spend_usd"),
    )
    u = unique_by(users.select("user_id", "signup_date", F.col("acquisition_channel").alias("channel")), ["user_id"], "users")
    per_user = span_sums(u, _daily_revenue(events), "user_id", "signup_date", F.date_add("signup_date", window_days),
                         "event_date", "_rev", "_revenue")
    j = totals.join(per_user.groupBy("channel").agg(F.count("user_id").alias("_users"), F.sum("_revenue").alias("_r30")), "channel", "left")
    j = j.withColumns({
        "new_users": F.coalesce("_users", F.lit(0)),
        "revenue_30d": F.coalesce("_r30", F.lit(0.0)),
    })
    return j.select(
        "channel", "impressions", "clicks", "installs", F.col("spend_usd"),
        F.col("target_spend_usd"), "new_users", F.col("revenue_30d"),
        safe_divide("spend_usd", "new_users").alias("cac_usd"),
        safe_divide("revenue_30d", "new_users").alias("ltv_30d_usd"),
        safe_divide("revenue_30d", "spend_usd").alias("roas_30d"),
        safe_divide("clicks", "impressions").alias("ctr"),
        safe_divide("installs", "clicks").alias("install_rate"),
    )


def marketing_decision(channels: DataFrame) -> DataFrame:
    return channels.select(
        "channel", "spend_usd", "cac_usd", "ltv_30d_usd", "roas_30d",
        F.when(F.col("roas_30d") >= 1, "Scale").otherwise("Rework").alias("decision"),
    ).orderBy(F.desc_nulls_last("roas_30d"), "channel")


def target_blend(channels: DataFrame, targets: DataFrame) -> DataFrame:
    """Actuals blended with exactly one target row per channel (validated)."""
    actual = channels.select("channel", "spend_usd", "cac_usd", "roas_30d")
    j = join_validated(actual, targets, "channel", "left", validate="many_to_one")
    return j.select(
        "channel", "spend_usd", "target_spend_usd",
        safe_divide("spend_usd", "target_spend_usd").alias("spend_to_target"),
        "cac_usd", "target_cac_usd", (F.col("cac_usd") > F.col("target_cac_usd")).alias("cac_above_target"),
        "roas_30d", "target_roas_30d", (F.col("roas_30d") < 1).alias("roas_below_one"),
    )
