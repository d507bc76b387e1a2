"""The ten marts (M1-M10): compositions of the operators over canonical tables.

Each builder takes the dict of canonical tables and returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from fanpulse.operators import engagement, experiment, football, marketing, quality
from fanpulse.operators.sessions import derived_sessions

Tables = dict[str, DataFrame]


def mart_sessions(t: Tables) -> DataFrame:
    ev = t["fact_app_events"].select("event_id", "user_id", "match_id", "event_name", "event_ts", "revenue_usd")
    return derived_sessions(ev)


def mart_product_daily(t: Tables) -> DataFrame:
    return engagement.product_daily(t["fact_app_events"])


def mart_retention_cohort(t: Tables) -> DataFrame:
    return engagement.cohort_retention(
        t["dim_users"], t["fact_app_events"], keys=("acquisition_channel", "platform"), by_cohort_date=True
    )


def mart_conversion_funnel(t: Tables) -> DataFrame:
    return engagement.funnel_mart(t["fact_app_events"])


def mart_sports_engagement(t: Tables) -> DataFrame:
    return football.sports_engagement(t["fact_app_events"], t["dim_content"], t["fact_match_events"], t["dim_matches"])


def mart_football_team_match(t: Tables) -> DataFrame:
    return football.team_match(t["dim_matches"], t["fact_match_events"])


def mart_key_moment_engagement(t: Tables) -> DataFrame:
    return football.key_moment_engagement(t["fact_match_events"], t["fact_app_events"])


def mart_marketing_economics(t: Tables) -> DataFrame:
    return marketing.unit_economics(t["dim_users"], t["fact_app_events"], t["fact_campaign_spend"])


def mart_ab_test_match_center_v2(t: Tables) -> DataFrame:
    return experiment.ab_test_mart(t["fact_experiment_assignments"], t["fact_app_events"])


def mart_data_quality(t: Tables, as_of=None) -> DataFrame:
    daily = mart_product_daily(t)
    return quality.mart_checks(
        t["fact_app_events"], t["fact_match_events"], t["dim_users"], t["fact_experiment_assignments"], daily,
        as_of=as_of,
    )


MARTS = {
    "mart_sessions": mart_sessions,
    "mart_product_daily": mart_product_daily,
    "mart_retention_cohort": mart_retention_cohort,
    "mart_conversion_funnel": mart_conversion_funnel,
    "mart_sports_engagement": mart_sports_engagement,
    "mart_football_team_match": mart_football_team_match,
    "mart_key_moment_engagement": mart_key_moment_engagement,
    "mart_marketing_economics": mart_marketing_economics,
    "mart_ab_test_match_center_v2": mart_ab_test_match_center_v2,
    "mart_data_quality": mart_data_quality,
}
