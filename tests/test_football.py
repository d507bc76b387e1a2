import datetime as dt

import pytest
from conftest import app_events, d, ts
from pyspark.sql import functions as F

from fanpulse.operators.experiment import ab_test_report
from fanpulse.operators.football import interval_counts, key_moment_engagement, session_anchor_audit, sports_report, team_match, window_counts
from fanpulse.schemas import CONTRACTS


def _match_events(spark, rows):
    """rows: (event_id, match_id, ts, period, event_type, team_id, possession_team_id, shot_outcome, xg, pass_outcome, duel_type)"""
    out = []
    for eid, mid, t, period, et, team, poss, so, xg, po, dtp in rows:
        out.append((eid, mid, 0, ts(t), period, 0, 0, et, team, None, poss, None, None, None, None, xg, so, po, dtp, False, 0.0))
    return spark.createDataFrame(out, CONTRACTS["fact_match_events"])


def _matches(spark):
    return spark.createDataFrame([(1, d("2024-01-01"), "00:00:00", 1, "Cup", 1, "2024", 10, "Home", 20, "Away", 1, 0)],
                                 CONTRACTS["dim_matches"])


def test_interval_counts_equals_brute_force(tables):
    me = tables["fact_match_events"].where("period <= 4 AND event_type IN ('Shot', 'Substitution')")
    moments = me.select("event_id", "match_id", "event_ts")
    ev = tables["fact_app_events"].select("match_id", "event_ts", "event_id", "user_id")
    for half_open in (False, True):
        got = interval_counts(moments, ev, "match_id", "event_ts", "event_ts", 5, 5, half_open=half_open,
                              aggs=[F.count("_e_event_id").alias("n"), F.count_distinct("_e_user_id").alias("u")])
        got = {r.event_id: (r.n, r.u) for r in got.collect()}
        evs = ev.collect()
        for m in moments.collect():
            lo, hi = m.event_ts - dt.timedelta(minutes=5), m.event_ts + dt.timedelta(minutes=5)
            inside = [e for e in evs if e.match_id == m.match_id and lo <= e.event_ts and
                      (e.event_ts < hi if half_open else e.event_ts <= hi)]
            assert got[m.event_id] == (len(inside), len({e.user_id for e in inside}))


def test_window_counts_equal_paired_counts(tables):
    """Dense made-up moments over the given events: closed and half-open bounds, ties, repeated rows, NULL keys and users."""
    ev = tables["fact_app_events"].select(
        "match_id", F.date_trunc("minute", F.col("event_ts")).cast("timestamp_ntz").alias("event_ts"), "event_id", "user_id", "event_name")
    ev = ev.withColumn("match_id", F.when(F.col("event_id") % 17 != 0, F.col("match_id") % 2)).withColumn(
        "event_ts", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(pmod(hash(event_id), 600) as int))"))
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 5 != 0, F.col("user_id"))).union(ev.where("event_id % 9 = 0"))
    mo = ev.select(F.col("event_id").alias("m_id"), "match_id", "event_ts").where("m_id % 3 = 0").distinct()
    for half_open in (False, True):
        slow = interval_counts(mo, ev, "match_id", "event_ts", "event_ts", 4, 6, half_open=half_open, aggs=[
            F.count("_e_event_id").alias("n"), F.count_if(F.col("_e_event_name") == "highlight_view").alias("views"),
            F.count_distinct("_e_user_id").alias("users")])
        fast = window_counts(mo, ev, "match_id", "event_ts", "event_ts", 4, 6, half_open=half_open, counts={
            "n": F.lit(True), "views": F.col("event_name") == "highlight_view"}, distinct={"users": "user_id"})
        key = lambda r: (r.m_id, r.n)
        a, b = ([tuple(r[c] for c in ("m_id", "n", "views", "users")) for r in sorted(x.collect(), key=key)] for x in (slow, fast))
        assert a == b and len(a) > 100 and max(r[1] for r in a) > 5
        assert all(r[1] == 0 for r in b if r[0] % 17 == 0)


def test_window_counts_without_events_or_moments(tables):
    ev = tables["fact_app_events"].select("match_id", "event_ts", "event_id", "user_id")
    mo = ev.limit(3)
    args = ("match_id", "event_ts", "event_ts", 5, 5, {"n": F.lit(True)}, {"u": "user_id"})
    got = window_counts(mo, ev.where("false"), *args, nearest="near").collect()
    assert [(r.n, r.u, r.near) for r in got] == [(0, 0, None)] * 3
    assert window_counts(mo.where("false"), ev, *args).count() == 0


def test_nearest_anchor_takes_the_earlier_of_two(spark):
    me = _match_events(spark, [
        (i, 1, t, 1, "Pass", 10, 10, None, None, None, None)
        for i, t in enumerate(("2024-01-01 00:00:00", "2024-01-01 00:08:00", "2024-01-01 00:16:00", "2024-01-01 00:16:00"))])
    ev = app_events(spark, [(1, 1, "2024-01-01 00:12:00", "app_open", 1), (2, 2, "2024-01-01 00:30:00", "app_open", 1)])
    rows = session_anchor_audit(ev, me).collect()
    assert [(r.anchors_within, r.nearest_anchor_ts, r.anchor_gap_seconds) for r in rows] == [(3, ts("2024-01-01 00:08:00"), 240.0)]


def test_report_merges_fail_on_repeated_keys(tables):
    content = tables["dim_content"]
    with pytest.raises(Exception, match="not unique in content"):
        sports_report(tables["fact_app_events"], content.union(content.limit(1)), tables["fact_match_events"], tables["dim_matches"]).collect()
    twice = tables["fact_experiment_assignments"]
    twice = twice.union(twice.withColumn("experiment_name", F.lit("other")))
    with pytest.raises(Exception, match="not unique in assignments"):
        ab_test_report(twice, tables["fact_app_events"]).collect()
    assert ab_test_report(twice, tables["fact_app_events"], experiment="match_center_v2").count() == 2


def test_key_moment_window_bounds_and_left_semantics(spark):
    me = _match_events(spark, [
        (1, 1, "2024-01-01 00:10:00", 1, "Shot", 10, 10, "Goal", 0.5, None, None),
        (2, 1, "2024-01-01 01:00:00", 2, "Substitution", 20, 20, None, None, None, None),
        (3, 1, "2024-01-01 01:30:00", 5, "Shot", 20, 20, "Goal", 0.9, None, None),   # shootout: excluded
    ])
    ev = app_events(spark, [
        (1, 1, "2024-01-01 00:05:00", "app_open", 1),        # exactly -5 min: inside (closed)
        (2, 2, "2024-01-01 00:15:00", "subscription_start", 1),  # exactly +5 min: inside
        (3, 3, "2024-01-01 00:15:01", "app_open", 1),        # outside
        (4, 3, "2024-01-01 00:10:00", "app_open", 2),        # other match
    ])
    rows = {r.event_id: r for r in key_moment_engagement(me, ev).collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].app_events_plus_minus_5m, rows[1].users_plus_minus_5m, rows[1].subscriptions_plus_minus_5m) == (2, 2, 1)
    assert rows[2].app_events_plus_minus_5m == 0  # left semantics: kept with zero
    # baseline: window [00:10-30m, 01:00+15m] = 95 whole minutes; 3 events of match 1 inside
    assert abs(rows[1].baseline_app_events_10m - 3 / 9.5) < 1e-6


def test_team_match_unnest_null_rates_and_possession(spark):
    me = _match_events(spark, [
        (1, 1, "2024-01-01 00:01:00", 1, "Shot", 10, 10, "Goal", 0.3, None, None),
        (2, 1, "2024-01-01 00:02:00", 1, "Pass", 10, None, None, None, "Complete", None),
        (3, 1, "2024-01-01 00:03:00", 1, "Duel", 10, 10, None, None, None, "Tackle"),
        (4, 1, "2024-01-01 00:04:00", 5, "Pass", 20, 20, None, None, "Complete", None),  # shootout
    ])
    rows = {r.team_id: r for r in team_match(_matches(spark), me).collect()}
    assert set(rows) == {10, 20}
    h, a = rows[10], rows[20]
    assert (h.shots, h.goals, h.passes, h.completed_passes, h.tackles, h.duels) == (1, 1, 1, 1, 1, 1)
    assert abs(h.possession_share - 2 / 3) < 1e-6       # NULL-possession event stays in the denominator
    assert a.passes == 0 and a.pass_completion_rate is None and a.possession_share is None
    lab = {r.team_id: r for r in team_match(_matches(spark), me, possession_denominator="labelled").collect()}
    assert lab[10].possession_share == 1.0
