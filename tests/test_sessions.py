from conftest import app_events
from pyspark.sql import functions as F

from fanpulse.operators.sessions import derived_sessions, session_rollup, sessionize, sessionize_single_window


def _numbers(df):
    return {r.event_id: r.derived_session_number for r in df.select("event_id", "derived_session_number").collect()}


def test_gap_is_whole_minutes(spark):
    ev = app_events(spark, [
        (1, 1, "2024-01-01 10:00:00", "app_open"),
        (2, 1, "2024-01-01 10:30:00", "app_open"),      # 30:00 -> same session
        (3, 1, "2024-01-01 11:00:59", "app_open"),      # 30:59 -> still same (truncated to 30)
        (4, 1, "2024-01-01 11:32:00", "app_open"),      # 31:01 -> new session
        (5, 2, "2024-01-01 10:00:00", "app_open"),
    ])
    n = _numbers(sessionize(ev))
    assert n == {1: 1, 2: 1, 3: 1, 4: 2, 5: 1}
    assert _numbers(sessionize_single_window(ev)) == n


def test_tie_break_by_event_id(spark):
    ev = app_events(spark, [
        (2, 1, "2024-01-01 10:00:00", "highlight_view", 7),
        (1, 1, "2024-01-01 10:00:00", "match_center_view", 3),
    ])
    out = derived_sessions(ev).collect()
    assert len(out) == 1 and out[0].match_id == 3  # first by (ts, event_id)
    assert out[0].unique_event_types == 2 and out[0].viewed_match_center and out[0].viewed_highlight


def test_sessions_cross_bucket_boundaries(spark):
    # events every 20 minutes across many 1-hour buckets form ONE session
    rows = [(i, 9, f"2024-01-01 {h:02d}:{m:02d}:00", "app_open") for i, (h, m) in
            enumerate([(h, m) for h in range(0, 6) for m in (0, 20, 40)])]
    rows.append((100, 9, "2024-01-01 07:00:00", "subscription_start"))  # 80 min gap -> new session
    ev = app_events(spark, rows)
    out = derived_sessions(ev).orderBy("derived_session_id").collect()
    assert [r.derived_session_id for r in out] == ["9-1", "9-2"]
    assert out[0].event_count == 18 and out[1].converted


def _rounded(df):
    return df.withColumn("net_revenue_usd", F.round("net_revenue_usd", 6))


def test_bins_equal_single_window_on_testdata(tables):
    ev = tables["fact_app_events"].select("event_id", "user_id", "match_id", "event_name", "event_ts", "revenue_usd")
    ev = ev.withColumn("user_id", F.when(F.col("event_name") != "app_open", F.col("user_id")))  # some have no user
    expected = _rounded(session_rollup(sessionize_single_window(ev)))
    for got in (derived_sessions(ev), session_rollup(sessionize(ev))):
        got = _rounded(got)
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_sessions_without_user_stay(spark):
    ev = app_events(spark, [(1, 1, "2024-01-01 10:00:00", "app_open"), (2, None, "2024-01-01 10:00:00", "app_open"),
                            (3, None, "2024-01-01 12:00:00", "app_open")])
    assert sorted((r.user_id is None, r.event_count) for r in derived_sessions(ev).collect()) == [(False, 1), (True, 1), (True, 1)]
    assert sessionize(ev).count() == 3


def test_duration_truncates_seconds(spark):
    ev = app_events(spark, [(1, 1, "2024-01-01 10:00:00.000000", "app_open"),
                            (2, 1, "2024-01-01 10:00:01.900000", "app_open")])
    r = derived_sessions(ev).collect()[0]
    assert r.duration_seconds == 1 and r.event_count == 2
    assert r.event_date.isoformat() == "2024-01-01"


def test_event_labels_equal_single_window(tables):
    ev = tables["fact_app_events"].select("event_id", "user_id", "match_id", "event_name", "event_ts", "revenue_usd")
    cols = ["event_id", "is_new_session", "derived_session_number"]
    expected = sessionize_single_window(ev).select(*cols)
    got = sessionize(ev).select(*cols)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
