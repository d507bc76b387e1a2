"""Published figures of the original build, fed through the closed-form parts.

Fixed values: per-segment counts from the original build's published extracts
(retention cohorts, funnel steps, marketing totals). The operators under test
must turn them into the published rates.
"""

from pyspark.sql import functions as F

from fanpulse.operators.marketing import marketing_decision
from fanpulse.plans.reports import funnel_steps, retention_by_channel, weighted_retention

# Channel, platform, cohort size, retained on D1, D7, D30
RETENTION = [
    ("organic", "android", 4983, 2385, 1792, 1138), ("organic", "ios", 3421, 1591, 1260, 794),
    ("organic", "web", 1004, 473, 358, 231), ("paid_search", "android", 2496, 1183, 880, 554),
    ("paid_search", "ios", 1711, 811, 578, 397), ("paid_search", "web", 546, 264, 202, 109),
    ("partner", "android", 1029, 489, 358, 241), ("partner", "ios", 740, 342, 243, 169),
    ("partner", "web", 231, 101, 80, 52), ("referral", "android", 1618, 766, 548, 362),
    ("referral", "ios", 1048, 497, 377, 273), ("referral", "web", 335, 162, 109, 86),
    ("social", "android", 3052, 1473, 1031, 708), ("social", "ios", 2138, 1017, 762, 518),
    ("social", "web", 648, 312, 232, 152),
]
# Platform, variant, journeys, notification, match center, highlight, subscription users
FUNNEL = [
    ("android", "control", 42426, 37350, 29730, 26064, 754), ("android", "treatment", 42579, 38930, 32686, 29295, 1041),
    ("ios", "control", 29009, 25450, 20332, 17871, 513), ("ios", "treatment", 29471, 27062, 22782, 20479, 706),
    ("web", "control", 8995, 7923, 6365, 5638, 157), ("web", "treatment", 8911, 8114, 6827, 6130, 176),
]
# Channel, spend, new users, 30-day revenue
MARKETING = [("paid_search", 77662.74, 4753, 2517.48), ("partner", 33812.2, 2000, 919.08),
             ("social", 58734.63, 5838, 3006.99)]


def _retention_rows(spark):
    rows = [(c, p, n, d1, d1 / n, d7, d7 / n, d30, d30 / n) for c, p, n, d1, d7, d30 in RETENTION]
    return spark.createDataFrame(rows, "acquisition_channel string, platform string, cohort_size long, "
                                       "retained_d1 long, retention_d1 double, retained_d7 long, retention_d7 double, "
                                       "retained_d30 long, retention_d30 double")


def test_weighted_overall_retention(spark):
    got = {r.day: r.retention for r in weighted_retention(_retention_rows(spark)).collect()}
    assert got == {1: 0.47464, 7: 0.3524, 30: 0.23136}


def test_retention_by_channel_order(spark):
    got = [r.acquisition_channel for r in retention_by_channel(_retention_rows(spark)).collect()]
    assert got[0] == "referral" and len(got) == 5


def test_funnel_steps_and_end_to_end(spark):
    rows = spark.createDataFrame(FUNNEL, "platform string, experiment_variant string, journeys long, "
                                         "notification_users long, match_center_users long, highlight_users long, "
                                         "subscription_users long")
    steps = {r.step: (r.users, r.share_of_first) for r in funnel_steps(rows).collect()}
    assert steps["Notification"] == (38930 + 27062 + 8114, 1.0)
    assert steps["Subscription"][0] == 1041 + 706 + 176
    e2e = rows.select("platform", "experiment_variant",
                      (F.col("subscription_users") / F.col("journeys")).alias("e")).collect()
    assert round({(r.platform, r.experiment_variant): r.e for r in e2e}[("android", "control")], 12) == 0.017772120869
    assert sum(r[2] for r in FUNNEL) == 161391


def test_marketing_cac_roas_and_decision(spark):
    rows = spark.createDataFrame(
        [(c, s, n, r, s / n, r / n, r / s) for c, s, n, r in MARKETING],
        "channel string, spend_usd double, new_users long, revenue_30d double, cac_usd double, ltv_30d_usd double, roas_30d double")
    out = marketing_decision(rows).collect()
    assert [r.channel for r in out] == ["social", "paid_search", "partner"]
    assert all(r.decision == "Rework" for r in out)
    by = {r.channel: r for r in out}
    assert round(by["social"].cac_usd, 4) == 10.0607 and round(by["social"].roas_30d, 4) == 0.0512
    assert round(by["paid_search"].cac_usd, 4) == 16.3397 and round(by["partner"].ltv_30d_usd, 4) == 0.4595
