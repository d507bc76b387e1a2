import pytest
from conftest import app_events, d
from pyspark.sql import functions as F

from fanpulse.functions.joins import CardinalityError, join_validated
from fanpulse.operators.marketing import campaign_targets, target_blend, unit_economics
from fanpulse.schemas import CONTRACTS


def test_ltv_window_is_31_dates_and_null_ratios(spark):
    users = spark.createDataFrame(
        [(1, d("2024-01-01"), "social", "ios", "X", "free"), (2, d("2024-01-01"), "organic", "ios", "X", "free")],
        CONTRACTS["dim_users"])
    ev = app_events(spark, [
        (1, 1, "2024-01-31 10:00:00", "subscription_start"),   # day 30: inside
        (2, 1, "2024-02-01 10:00:00", "subscription_start"),   # day 31: outside
        (3, 2, "2024-01-02 10:00:00", "subscription_start"),   # organic: not acquired
    ])
    spend = spark.createDataFrame(
        [(d("2024-01-01"), "social_20240101", "social", 1000, 20, 2, 50.0, 60.0),
         (d("2024-01-02"), "social_20240102", "social", 0, 0, 0, 10.0, 60.0)],
        CONTRACTS["fact_campaign_spend"])
    rows = {r.metric_date.isoformat(): r for r in unit_economics(users, ev, spend).collect()}
    a, b = rows["2024-01-01"], rows["2024-01-02"]
    assert a.new_users == 1 and abs(a.revenue_30d - 9.99) < 1e-9 and a.cac_usd == 50.0
    assert b.new_users == 0 and b.cac_usd is None and b.ltv_30d_usd is None and b.roas_30d is None
    assert b.click_through_rate is None


def test_join_validated_raises_on_duplicate_one_side(spark):
    left = spark.createDataFrame([("social", 1.0)], "channel string, spend_usd double")
    dup = spark.createDataFrame([("social", 1.0), ("social", 2.0)], "channel string, x double")
    with pytest.raises(CardinalityError):
        join_validated(left, dup, "channel", "left", "many_to_one")
    ok = join_validated(left, dup.limit(1), "channel", "left", "many_to_one")
    assert ok.count() == 1


def test_target_blend_flags(spark):
    actual = spark.createDataFrame(
        [("social", 60000.0, 10.0, 0.5), ("partner", 10.0, 1.0, 1.5)],
        "channel string, spend_usd double, cac_usd double, roas_30d double")
    rows = {r.channel: r for r in target_blend(actual, campaign_targets(spark)).collect()}
    assert rows["social"].cac_above_target and rows["social"].roas_below_one
    assert not rows["partner"].cac_above_target and not rows["partner"].roas_below_one
    assert abs(rows["social"].spend_to_target - 60000 / 57780) < 1e-6
    assert actual.select(F.count("*")).first()[0] == 2


def test_spend_grain_guard(spark):
    from fanpulse.operators.marketing import check_spend_grain
    spend = spark.createDataFrame(
        [(d("2024-01-01"), "social_a", "social", 1, 1, 1, 1.0, 1.0), (d("2024-01-01"), "social_b", "social", 1, 1, 1, 1.0, 1.0)],
        CONTRACTS["fact_campaign_spend"])
    with pytest.raises(CardinalityError):
        check_spend_grain(spend)
    check_spend_grain(spend.limit(1))


def test_decisions_use_exact_values(spark):
    from fanpulse.operators.experiment import experiment_decision
    from fanpulse.operators.marketing import marketing_decision

    ch = spark.createDataFrame([("social", 1.0, 1.0, 1.0, 0.9999997)], "channel string, spend_usd double, cac_usd double, ltv_30d_usd double, roas_30d double")
    assert marketing_decision(ch).first().decision == "Rework"
    ab = spark.createDataFrame([(0.1, 0.1, 4.3e-7, 0.2)], "absolute_lift double, relative_lift double, ci_95_lower double, ci_95_upper double")
    assert experiment_decision(ab).first().decision == "Significant lift"
