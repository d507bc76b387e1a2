import os

import pytest
from pyspark.sql import functions as F

from fanpulse.plans import layout_queries
from fanpulse.plans.layout_queries import weekend_activity
from fanpulse.sources import bucketed, io, versions


def _days(spark, days, factor=1):
    return spark.createDataFrame([(d, k, factor * k) for d in days for k in range(5)], "day int, k int, v int")


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_killed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write(_days(spark, [1, 2]), path, ["day"])
    bad = _days(spark, [1, 2, 3]).withColumn("v", F.expr("if(day = 3, raise_error('lost'), v)").cast("int"))
    with pytest.raises(Exception, match="lost"):
        versions.write(bad, path, ["day"])
    assert versions.numbers(spark, path) == [1] and versions.read(spark, path).agg(F.sum("v")).first()[0] == 20
    with pytest.raises(Exception, match="lost"):
        versions.write(bad, path, ["day"], only_touched=True)
    assert versions.read(spark, path).count() == 10


def test_replay_touches_one_date_only(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write(_days(spark, [1, 2, 3]), path, ["day"], keys=["k"])
    before = _files(path)
    own = versions.read(spark, path)
    m = versions.write(own.where("day = 2 and k > 1").withColumn("v", F.col("v") * 10), path, ["day"], only_touched=True)  # from its own rows
    assert m["version"] == 2 and m["written"] == ["day=2"] and m["metrics"]["rows"] == 13 and m["metrics"]["written_rows"] == 3
    after = _files(path)
    assert all(after[f] == t for f, t in before.items())
    got = {r.day: r.s for r in versions.read(spark, path).groupBy("day").agg(F.sum("v").alias("s")).collect()}
    assert got == {1: 10, 2: 90, 3: 10}
    assert versions.read(spark, path, 1).count() == 15  # the version before is still there
    assert versions.read(spark, path).columns == ["day", "k", "v"]
    gone = versions.expire(spark, path)
    assert len(gone) == 1 and gone[0].endswith("day=2") and versions.numbers(spark, path) == [2]
    assert versions.read(spark, path).count() == 13
    m = versions.write(_days(spark, [9]), path, ["day"], only_touched=True)  # a new date
    assert m["metrics"]["rows"] == 18 and len(m["folders"]) == 4


def test_two_writers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.write(_days(spark, [1, 2]), path, ["day"])
    commit, other = versions._commit, {}

    def late(spark_, path_, entry):  # another writer commits first
        if not other.get("done"):
            other["done"] = True
            versions.write(_days(spark, [other["day"]], 3), path, ["day"], only_touched=True)
        return commit(spark_, path_, entry)

    monkeypatch.setattr(versions, "_commit", late)
    other["day"] = 1
    versions.write(_days(spark, [2], 2), path, ["day"], only_touched=True)  # another date: both stay
    assert {r.day: r.s for r in versions.read(spark, path).groupBy("day").agg(F.sum("v").alias("s")).collect()} == {1: 30, 2: 20}
    other.clear()
    other["day"] = 2
    with pytest.raises(versions.CommitConflict):
        versions.write(_days(spark, [2], 5), path, ["day"], only_touched=True)
    other.clear()
    other["day"] = 1
    with pytest.raises(versions.CommitConflict):
        versions.write(_days(spark, [7]), path, ["day"])


def test_whole_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    rows = spark.createDataFrame([(1, None), (2, "x")], "a int, version_id string")  # a column of the folders' name
    m = versions.write(rows, path, keys=["a", "version_id"], metrics={"most": F.max("a")})
    assert m["metrics"] == {"rows": 2, "null_keys": 1, "most": 2, "written_rows": 2}
    assert sorted(r.a for r in versions.read(spark, path).collect()) == [1, 2]
    versions.write(versions.read(spark, path).where("a > 1"), path)  # reads the table it replaces
    assert [tuple(r) for r in versions.read(spark, path).collect()] == [(2, "x")]
    empty = str(tmp_path / "e")
    m = versions.write(_days(spark, []), empty, ["day"])
    assert m["folders"] == {} and versions.read(spark, empty).columns == ["day", "k", "v"] and versions.read(spark, empty).count() == 0
    with pytest.raises(ValueError):
        versions.write(_days(spark, [1]).withColumnRenamed("v", "w"), empty, ["day"], only_touched=True)


def test_reads_are_pruned(spark, tables, tmp_path):
    path = str(tmp_path)
    io.write_with_layout({n: tables[n] for n in ("fact_app_events", "dim_date", "fact_match_events")}, path)
    events, dates = (io.read_layout_table(spark, path, n) for n in ("fact_app_events", "dim_date"))
    joined = weekend_activity(events, dates)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "PartitionFilters: [isnotnull(event_date" in plan
    days = events.select("event_date").distinct().count()
    one = io.day_range(spark, path, "fact_app_events", "2024-01-06", "2024-01-07")
    assert "PartitionFilters: [" in one._jdf.queryExecution().executedPlan().toString()
    files = lambda df: df.select(F.input_file_name().alias("f")).distinct().count()
    assert 0 < files(one) < files(events) and one.select("event_date").distinct().count() == 2 < days
    shots = io.day_range(spark, path, "fact_match_events", "2024-01-01", "2024-01-01").where("event_type = 'Shot'")
    plan = shots._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,Shot)]" in plan and "event_ts_day" not in shots.columns


def test_bucketed_joins_have_no_exchange_on_the_key(spark, tables, tmp_path):
    names = ("dim_users", "fact_app_events")
    users, events = bucketed.stored(spark, str(tmp_path), {n: tables[n] for n in names}, "user_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = events.join(users.select("user_id", "signup_date"), "user_id").groupBy("user_id").agg(F.sum("revenue_usd"))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        for build in (layout_queries.bucketed_user_economics, layout_queries.bucketed_ab_test):
            plan = build(tables)._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and "hashpartitioning(user_id" not in plan and "hashpartitioning(_key" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_marts_survive_a_failed_build(spark, tables, tmp_path, monkeypatch):
    from fanpulse.plans import marts, pipeline

    monkeypatch.setattr(pipeline, "MART_ORDER", ("mart_product_daily",))
    pipeline.build_marts(tables, str(tmp_path))
    rows = io.read_tables(spark, str(tmp_path), ["mart_product_daily"])["mart_product_daily"].count()
    good = marts.MARTS["mart_product_daily"]
    monkeypatch.setitem(marts.MARTS, "mart_product_daily", lambda t: good(t).withColumn("dau", F.expr("raise_error('lost')").cast("long")))
    with pytest.raises(Exception, match="lost"):
        pipeline.build_marts(tables, str(tmp_path))
    assert io.read_layout_table(spark, str(tmp_path), "mart_product_daily").count() == rows > 0
