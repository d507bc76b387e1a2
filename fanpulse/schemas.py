"""Table contracts of the star schema: column types, primary keys, layout.

Contract checks (quality.validate) look at names only for the verdict,
like the original suite; the StructTypes are used for JSON ingestion and
for the hand fixtures.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
DT, TS = T.DateType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Canonical contracts. Keys are BIGINT here (strings in the original data);
# the operators never depend on the key type.
CONTRACTS: dict[str, T.StructType] = {
    "dim_date": _struct(
        ("date", DT), ("year", I), ("quarter", I), ("month", I), ("month_name", S),
        ("iso_week", I), ("day_of_week", I), ("day_name", S), ("is_weekend", B),
    ),
    "dim_users": _struct(
        ("user_id", L), ("signup_date", DT), ("acquisition_channel", S), ("platform", S),
        ("country", S), ("subscription_tier", S),
    ),
    "dim_matches": _struct(
        ("match_id", L), ("match_date", DT), ("kick_off", S), ("competition_id", L),
        ("competition_name", S), ("season_id", L), ("season_name", S), ("home_team_id", L),
        ("home_team_name", S), ("away_team_id", L), ("away_team_name", S),
        ("home_score", L), ("away_score", L),
    ),
    "dim_teams": _struct(("team_id", L), ("team_name", S)),
    "dim_players": _struct(("player_id", L), ("player_name", S), ("team_id", L), ("team_name", S)),
    "dim_content": _struct(
        ("content_id", S), ("match_id", L), ("content_type", S), ("published_at", TS),
        ("team_id", L), ("player_id", L),
    ),
    "fact_match_events": _struct(
        ("event_id", L), ("match_id", L), ("event_index", I), ("event_ts", TS), ("period", I),
        ("minute", I), ("second", I), ("event_type", S), ("team_id", L), ("player_id", L),
        ("possession_team_id", L), ("x", D), ("y", D), ("end_x", D), ("end_y", D),
        ("shot_xg", D), ("shot_outcome", S), ("pass_outcome", S), ("duel_type", S),
        ("under_pressure", B), ("duration_seconds", D),
    ),
    "fact_app_events": _struct(
        ("event_id", L), ("user_id", L), ("session_id", S), ("event_ts", TS), ("event_date", DT),
        ("event_name", S), ("match_id", L), ("content_id", S), ("platform", S),
        ("acquisition_channel", S), ("experiment_variant", S), ("campaign_id", S),
        ("revenue_usd", D),
    ),
    "fact_campaign_spend": _struct(
        ("spend_date", DT), ("campaign_id", S), ("channel", S), ("impressions", L),
        ("clicks", L), ("installs", L), ("spend_usd", D), ("target_spend_usd", D),
    ),
    "fact_experiment_assignments": _struct(
        ("user_id", L), ("experiment_name", S), ("variant", S), ("assigned_at", TS),
    ),
}

TABLES: tuple[str, ...] = tuple(CONTRACTS)

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_date": ("date",),
    "dim_users": ("user_id",),
    "dim_matches": ("match_id",),
    "dim_teams": ("team_id",),
    "dim_players": ("player_id",),
    "dim_content": ("content_id",),
    "fact_match_events": ("event_id",),
    "fact_app_events": ("event_id",),
    "fact_campaign_spend": ("spend_date", "campaign_id"),
    "fact_experiment_assignments": ("user_id", "experiment_name"),
}

# Physical layout: a date partition column (derived for match events) and
# the columns to sort by inside each partition (min/max skipping).
LAYOUT: dict[str, dict[str, object]] = {
    "dim_date": {"clusters": ["date"]},  # dimensions are sorted: a folder per date would hold a row each
    "dim_users": {},
    "dim_matches": {"clusters": ["match_date", "competition_id"]},
    "dim_teams": {},
    "data_quality_results": {},
    "dim_players": {"clusters": ["team_id"]},
    "dim_content": {"clusters": ["match_id", "content_type"]},
    "fact_match_events": {"partition": "event_ts", "day": True, "clusters": ["match_id", "event_type"]},
    "fact_app_events": {"partition": "event_date", "clusters": ["user_id", "match_id", "event_name"]},
    "fact_campaign_spend": {"partition": "spend_date", "clusters": ["channel"]},
    "fact_experiment_assignments": {"clusters": ["experiment_name", "variant"]},
    # marts: only sessions have more than a handful of rows a date; the others are sorted, a folder per date would be tiny
    "mart_sessions": {"partition": "event_date", "clusters": ["user_id", "match_id"]},
    "mart_product_daily": {"clusters": ["metric_date"]},
    "mart_retention_cohort": {"clusters": ["cohort_date", "acquisition_channel", "platform"]},
    "mart_conversion_funnel": {"clusters": ["funnel_date", "platform", "experiment_variant"]},
    "mart_sports_engagement": {"clusters": ["competition_name", "match_id", "content_type"]},
    "mart_football_team_match": {"clusters": ["match_id", "team_id"]},
    "mart_key_moment_engagement": {"clusters": ["match_id", "event_type"]},
    "mart_marketing_economics": {"clusters": ["metric_date", "channel"]},
}

# Fixed values of the product domain.
CHANNELS = ("organic", "paid_search", "social", "referral", "partner")
PAID_CHANNELS = ("paid_search", "social", "partner")
PLATFORMS = ("android", "ios", "web")
CONTENT_TYPES = ("match_center", "highlight", "live_blog", "player_story")
FUNNEL_STEPS = ("notification_click", "match_center_view", "highlight_view", "subscription_start")
FUNNEL_ENTRY = ("app_open",)
VIEW_EVENTS = ("match_center_view", "highlight_view")
KEY_MOMENT_TYPES = ("Substitution", "Bad Behaviour")
