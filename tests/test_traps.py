"""Remaining semantic traps: NULL content group, zero denominators, COUNTIF on
empty input, unknown-user fan-out, report vs mart marketing grain."""

from conftest import app_events, d
from pyspark.sql import functions as F

from fanpulse.functions.scalar import count_if, safe_divide
from fanpulse.operators.football import sports_engagement
from fanpulse.operators.marketing import channel_economics
from fanpulse.operators.quality import mart_checks
from fanpulse.schemas import CONTRACTS


def test_safe_divide_and_countif_empty(spark):
    df = spark.createDataFrame([(1, 0), (None, 2)], "a int, b int")
    r = df.select(safe_divide("a", "b").alias("q")).collect()
    assert r[0].q is None and r[1].q is None
    assert df.where("a > 100").agg(count_if(F.col("a") > 0).alias("n")).first().n == 0


def test_untyped_content_forms_null_group(spark, tables):
    ev = app_events(spark, [
        (1, 1, "2024-01-01 10:00:00", "app_open", 0),
        (2, 1, "2024-01-01 10:01:00", "subscription_start", 0),
        (3, 2, "2024-01-01 10:02:00", "match_center_view", 0, 0.0, "s2", "ios", "control", "C0_match_center"),
    ])
    rows = {r.content_type: r for r in sports_engagement(ev, tables["dim_content"], tables["fact_match_events"],
                                                         tables["dim_matches"]).collect()}
    assert set(rows) == {None, "match_center"}
    assert rows[None].subscriptions == 1 and rows["match_center"].subscriptions == 0
    assert rows[None].viewer_conversion_rate == 1.0


def test_unknown_user_fans_out_only_matched_rows(spark):
    ev = app_events(spark, [(1, 1, "2024-01-01 10:00:00", "app_open"), (2, 9, "2024-01-01 10:00:00", "app_open"),
                            (3, 9, "2024-01-01 11:00:00", "app_open")])
    users = spark.createDataFrame([(1, d("2024-01-01"), "organic", "ios", "X", "free")] * 2, CONTRACTS["dim_users"])
    empty_me = spark.createDataFrame([], CONTRACTS["fact_match_events"])
    assign = spark.createDataFrame([], CONTRACTS["fact_experiment_assignments"])
    daily = ev.select(F.col("event_date").alias("metric_date"), "revenue_usd")
    res = {r.check_name: r.observed for r in mart_checks(ev, empty_me, users, assign, daily).collect()}
    assert res["app_events.unknown_user"] == 2 and res["fact_match_events.invalid_xg"] == 0
    assert res["product_daily.revenue_reconciliation"] == 0


def test_report_marketing_counts_all_channel_users(spark):
    users = spark.createDataFrame(
        [(1, d("2024-01-01"), "social", "ios", "X", "free"), (2, d("2024-01-05"), "social", "ios", "X", "free")],
        CONTRACTS["dim_users"])
    ev = app_events(spark, [(1, 1, "2024-01-01 10:00:00", "subscription_start"),
                            (2, 2, "2024-01-04 10:00:00", "subscription_start")])  # before signup: excluded
    spend = spark.createDataFrame([(d("2024-01-01"), "social_20240101", "social", 100, 10, 1, 20.0, 30.0)],
                                  CONTRACTS["fact_campaign_spend"])
    r = channel_economics(users, ev, spend).collect()[0]
    assert r.new_users == 2 and abs(r.revenue_30d - 9.99) < 1e-9 and r.cac_usd == 10.0
