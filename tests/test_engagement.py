import datetime as dt

from conftest import app_events, d
from pyspark.sql import functions as F

from fanpulse.operators.engagement import (cohort_retention, funnel_mart, funnel_report, ordered_funnel,
                                           product_daily, trailing_distinct)


def test_trailing_distinct_matches_brute_force(tables):
    ev = tables["fact_app_events"].select("event_date", "user_id")
    rows = ev.distinct().collect()
    dates = {r.event_date for r in rows}
    for days in (1, 7, 30):
        for method in ("ranges", "explode"):
            got = {r.metric_date: r.mau for r in trailing_distinct(ev, days=days, method=method).collect()}
            for day in dates:
                lo = day - dt.timedelta(days=days - 1)
                assert got[day] == len({r.user_id for r in rows if lo <= r.event_date <= day}), (days, method)
            assert set(got) == dates  # only dates with activity (no calendar fill)


def test_trailing_distinct_sparse_days(spark):
    ev = spark.createDataFrame(
        [(d("2024-01-01"), 1), (d("2024-01-30"), 1), (d("2024-01-31"), 1), (d("2024-03-01"), 1),
         (d("2024-01-31"), 2), (d("2024-03-01"), 2)], "event_date date, user_id long")
    got = {r.metric_date.isoformat(): r.mau for r in trailing_distinct(ev).collect()}
    assert got == {"2024-01-01": 1, "2024-01-30": 1, "2024-01-31": 2, "2024-03-01": 2}


def test_no_nested_loop_in_trailing_plan(tables):
    plan = product_daily(tables["fact_app_events"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_mau_at_least_dau(tables):
    assert product_daily(tables["fact_app_events"]).where("mau < dau").count() == 0


def test_retention_keeps_inactive_users_and_exact_days(spark):
    users = spark.createDataFrame(
        [(1, d("2024-01-01"), "organic", "ios"), (2, d("2024-01-01"), "organic", "ios"), (3, d("2024-01-01"), "organic", "ios")],
        "user_id long, signup_date date, acquisition_channel string, platform string")
    ev = app_events(spark, [
        (1, 1, "2024-01-02 10:00:00", "app_open"),   # D1
        (2, 1, "2024-01-08 10:00:00", "app_open"),   # D7
        (3, 2, "2024-01-03 10:00:00", "app_open"),   # D2 only
        (4, 2, "2023-12-31 10:00:00", "app_open"),   # before signup
    ])
    r = cohort_retention(users, ev).collect()[0]
    assert (r.cohort_size, r.retained_d1, r.retained_d7, r.retained_d30) == (3, 1, 1, 0)
    assert abs(r.retention_d1 - 1 / 3) < 1e-6 and r.churn_d30 == 1.0
    rep = cohort_retention(users, ev, by_cohort_date=False).collect()[0]
    assert rep.cohort_size == 3 and "cohort_date" not in rep.asDict()


def test_funnel_first_overall_and_strict_order(spark):
    ev = app_events(spark, [
        # journey A: notification, match center later, highlight at SAME time as match center -> stops at step 2
        (1, 1, "2024-01-01 10:00:00", "notification_click"),
        (2, 1, "2024-01-01 10:05:00", "match_center_view"),
        (3, 1, "2024-01-01 10:05:00", "highlight_view"),
        # journey B: match center BEFORE notification (first overall), later again -> not reached
        (4, 2, "2024-01-01 09:00:00", "match_center_view"),
        (5, 2, "2024-01-01 10:00:00", "notification_click"),
        (6, 2, "2024-01-01 11:00:00", "match_center_view"),
        # journey C: app_open only (counts in the mart, not in the report)
        (7, 3, "2024-01-01 10:00:00", "app_open"),
    ])
    j = {r.user_id: r for r in ordered_funnel(ev).collect()}
    assert j[1].reached_match_center_view and not j[1].reached_highlight_view
    assert j[2].reached_notification_click and not j[2].reached_match_center_view
    assert not j[3].reached_notification_click
    m = funnel_mart(ev).collect()[0]
    assert (m.user_match_journeys, m.notification_users, m.match_center_users, m.highlight_users) == (3, 2, 1, 0)
    assert m.match_to_highlight == 0.0 and m.highlight_to_subscription is None
    rep = funnel_report(ev).collect()[0]
    assert rep.journeys == 2


def test_funnel_never_increases(tables):
    f = funnel_mart(tables["fact_app_events"])
    bad = f.where("match_center_users > notification_users OR highlight_users > match_center_users "
                  "OR subscription_users > highlight_users")
    assert bad.count() == 0
    assert f.select(F.sum("user_match_journeys")).first()[0] > 0


def test_null_users_are_nobody(spark):
    from fanpulse.operators.engagement import executive_daily, product_daily

    ev = app_events(spark, [(1, 1, "2024-01-01 10:00:00", "app_open"), (2, None, "2024-01-01 10:00:00", "app_open"),
                            (3, None, "2024-01-02 12:00:00", "app_open")])
    daily = {r.metric_date.day: (r.dau, r.mau, r.events) for r in product_daily(ev).collect()}
    assert daily == {1: (1, 1, 2), 2: (0, 1, 1)}
    assert {r.event_date.day: (r.dau, r.mau) for r in executive_daily(ev).collect()} == {1: (1, 1), 2: (0, 1)}
    for method in ("ranges", "explode"):
        rows = trailing_distinct(ev, method=method).collect()
        assert {r.metric_date.day: r.mau for r in rows} == {1: 1, 2: 1}
