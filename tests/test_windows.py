"""Windows and spans against brute force: bounds, ties, repeated rows, NULL keys, no rows."""

import datetime as dt

import pytest
from conftest import d, ts
from pyspark.sql import functions as F

from fanpulse.operators.marketing import channel_economics, unit_economics
from fanpulse.operators.windows import span_sums, window_merged

def _aggs():
    return {"least": ("min", F.col("v")), "greatest": ("max", F.col("v")), "total": ("sum", F.col("v")),
            "first": ("first", F.col("name")), "last": ("last", F.col("name"))}


def _events(spark):
    rows = [(i, None if i % 17 == 0 else i % 2, ts("2024-01-01 00:00:00") + dt.timedelta(seconds=60 * ((i * 7919) % 600) + (i % 3 == 0)),
             None if i % 5 == 0 else float((i * 31) % 101), f"n{i % 7}") for i in range(700)]
    return spark.createDataFrame(rows, "id int, k int, t timestamp_ntz, v double, name string")


@pytest.mark.parametrize("before,after,half_open", [(4, 6, False), (4, 6, True), (0, 3, False), (3, 0, True)])
def test_window_merged_equals_brute_force(spark, before, after, half_open):
    ev = _events(spark)
    mo = ev.where("id % 3 = 0").select(F.col("id").alias("m"), "k", F.col("t").alias("at"))
    mo = mo.union(mo.where("id % 9 = 0")).union(spark.createDataFrame(
        [(-1, 1, None), (-2, 5, ts("2024-01-01 00:00:00"))], mo.schema))
    got = window_merged(mo, ev, "k", "at", "t", before, after, _aggs(), tiebreak="id", half_open=half_open)
    assert got.columns == [*mo.columns, *_aggs()]
    all_events, expected = ev.collect(), []
    for m in mo.collect():
        inside = []
        if m.at is not None and m.k is not None:
            lo, hi = m.at - dt.timedelta(minutes=before), m.at + dt.timedelta(minutes=after)
            inside = sorted((e.t, e.id, e.v, e.name) for e in all_events if e.k == m.k and lo <= e.t and (e.t < hi if half_open else e.t <= hi))
        vs = [e[2] for e in inside if e[2] is not None]
        expected.append((m.m, m.k, m.at, min(vs, default=None), max(vs, default=None), sum(vs) if vs else None,
                         inside[0][3] if inside else None, inside[-1][3] if inside else None))
    order = lambda r: (r[0], str(r[2]))
    assert sorted(map(tuple, got.collect()), key=order) == sorted(expected, key=order)
    assert sum(r[3] != r[4] for r in expected) > 20


def test_window_merged_makes_no_pairs_and_takes_empty_tables(spark):
    ev = _events(spark)
    mo = ev.select("id", "k", F.col("t").alias("at"))
    plan = window_merged(mo, ev, "k", "at", "t", 5, 5, _aggs(), tiebreak="id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and ">=" not in plan
    none = window_merged(mo, ev.where("false"), "k", "at", "t", 5, 5, _aggs(), tiebreak="id").where("least is null and first is null")
    assert none.count() == mo.count()
    assert window_merged(mo.where("false"), ev, "k", "at", "t", 5, 5, _aggs(), tiebreak="id").count() == 0
    with pytest.raises(ValueError):
        window_merged(mo, ev, "k", "at", "t", 0, 0, _aggs(), tiebreak="id")


def test_span_sums_equal_brute_force(spark):
    amounts = spark.createDataFrame(
        [(None if i % 13 == 0 else i % 4, d("2024-01-01") + dt.timedelta(days=(i * 7) % 90), float(i % 11)) for i in range(300)], "k int, day date, x double")
    spans = spark.createDataFrame(
        [(i % 5, None if i % 10 == 0 else d("2024-01-01") + dt.timedelta(days=i), i % 2) for i in range(60)] + [(1, d("2024-01-05"), 0)] * 3
        + [(None, d("2024-01-05"), 0)], "k int, begun date, tag int")
    got = span_sums(spans, amounts, "k", "begun", F.date_add("begun", 30), "day", "x", "total")
    rows = amounts.collect()

    def total(s):
        return 0.0 if s.begun is None or s.k is None else sum(r.x for r in rows if r.k == s.k and s.begun <= r.day <= s.begun + dt.timedelta(days=30))

    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=order) == sorted(((*s, total(s)) for s in spans.collect()), key=order)
    assert got.where("total > 0").count() > 20


def test_economics_join_no_range(tables):
    users, events, spend = tables["dim_users"], tables["fact_app_events"], tables["fact_campaign_spend"]
    for build in (unit_economics, channel_economics):
        plan = build(users, events, spend)._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join " in line]
        assert joins and not any(">=" in line or "<=" in line for line in joins), joins
