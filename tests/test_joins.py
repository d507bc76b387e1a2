"""Events without content are dealt over the tasks of the join with the content table, and counted as by a plain join."""

import pytest
from conftest import app_events, d
from pyspark.sql import functions as F

from fanpulse.functions.joins import left_join_spread
from fanpulse.operators import football
from fanpulse.operators.engagement import engagement_drill
from fanpulse.operators.football import sports_engagement, sports_report
from fanpulse.schemas import CONTRACTS


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, as over large tables."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _content(spark, ids):
    rows = [(i, 1, t, None, None, None) for i, t in ids]
    return spark.createDataFrame(rows, CONTRACTS["dim_content"])


def _events(spark):
    rows = [(i, i % 50, "2024-01-01 10:00:00", "app_open", 1, 0.0, f"s{i % 200}") for i in range(400)]
    rows += [(400 + i, i, "2024-01-01 10:00:00", "match_center_view", 1, 0.0, f"s{i}", "ios", "control", c) for i, c in enumerate(["C1", "C1", "C2", "0", "017", "", "C9"])]
    return app_events(spark, rows)


def test_left_join_spread_is_a_left_join(spark, shuffled):
    ev = _events(spark)
    content = _content(spark, [("C1", "a"), ("C1", "b"), ("C2", None), (None, "x"), ("0", "y"), ("", "z")]).select("content_id", "content_type")
    got = left_join_spread(ev, content, "content_id", ["user_id", "session_id"])
    want = ev.join(content, "content_id", "left")
    assert set(got.columns) == set(want.columns) and got.count() == 409
    assert got.select(want.columns).exceptAll(want).isEmpty() and want.exceptAll(got.select(want.columns)).isEmpty()


def _busiest(spark, monkeypatch, make):
    """Share of the events without content that the busiest task of the join with the content holds."""
    seen = []

    def distinct_keys(df, *a, **k):
        seen.append(df)
        return group_by(df, *a, **k)

    group_by = type(spark.range(1)).groupBy
    monkeypatch.setattr(type(spark.range(1)), "groupBy", distinct_keys)
    make()
    monkeypatch.undo()
    ev = next(df for df in seen if {"content_type", "user_id", "revenue_usd"} <= set(df.columns))
    counts = [r["count"] for r in ev.where("event_name = 'app_open'").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 400
    return max(counts) / sum(counts)


def _tables(spark):
    matches = spark.createDataFrame([(1, d("2024-01-01"), "00:00:00", 1, "Cup", 1, "2024", 10, "Home", 20, "Away", 1, 0)], CONTRACTS["dim_matches"])
    content = _content(spark, [("C1", "a"), ("C2", "b")])
    play = spark.createDataFrame([], CONTRACTS["fact_match_events"])
    return content, play, matches


def test_mart_spreads_events_without_content(spark, shuffled, monkeypatch):
    assert _busiest(spark, monkeypatch, lambda: sports_engagement(_events(spark), *_tables(spark))) < 0.5
    found = {r.content_type: (r.views, r.unique_viewers, r.sessions) for r in football._engagement(_events(spark), _tables(spark)[0]).collect()}
    assert found == {None: (404, 50, 200), "a": (2, 2, 2), "b": (1, 1, 1)}


def test_report_spreads_events_without_content(spark, shuffled, monkeypatch):
    assert _busiest(spark, monkeypatch, lambda: sports_report(_events(spark), *_tables(spark))) < 0.5


def test_drill_spreads_groups_without_content(spark, shuffled, monkeypatch):
    seen = []

    def joined(df, *a, **k):
        seen.append(join(df, *a, **k))
        return seen[-1]

    join = type(spark.range(1)).join
    ev = app_events(spark, [(i, 7, "2024-01-01 10:00:00", "app_open", i) for i in range(200)])
    content, _, matches = _tables(spark)
    monkeypatch.setattr(type(spark.range(1)), "join", joined)
    drill = engagement_drill(ev, content, matches)
    monkeypatch.undo()
    rows = next(df for df in seen if "content_type" in df.columns and "competition_name" not in df.columns)
    counts = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 200 and max(counts) < 100
    assert drill.where("level = 7").collect()[0][4:] == (200, 1, 0)
