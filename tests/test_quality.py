import pytest
from pyspark.sql import functions as F

from fanpulse.operators.quality import DataQualityError, assert_valid, validate
from fanpulse.plans import marts


def _status(results):
    return {r.check_name: (r.status, r.observed) for r in results.collect()}


def _small(tables):
    """Canonical tables restricted by key so the negative tests stay fast."""
    t = dict(tables.items())
    return t


def test_clean_tables_pass_all_39(tables):
    res = _status(validate(dict(tables.items())))
    assert len(res) == 39
    assert all(s == "PASS" for s, _ in res.values()), {k: v for k, v in res.items() if v[0] != "PASS"}
    out = assert_valid(dict(tables.items()), as_of="2024-02-01 00:00:00")
    assert "checked_at" in out.columns


def test_negative_cases(tables):
    t = dict(tables.items())
    users = t["dim_users"]
    t["dim_users"] = users.unionByName(users.limit(1))                       # duplicate PK
    me = t["fact_match_events"]
    t["fact_match_events"] = me.withColumn("shot_xg", F.when(F.col("event_id") == 1, F.lit(1.4)).otherwise(F.col("shot_xg")))
    ev = t["fact_app_events"]
    bad = ev.limit(1).withColumns({"event_id": F.lit(-1).cast("long"), "user_id": F.lit(-5).cast("long"),
                                   "match_id": F.lit(99).cast("long")})
    t["fact_app_events"] = ev.unionByName(bad)                              # unknown user + bad match (T17)
    a = t["fact_experiment_assignments"]
    t["fact_experiment_assignments"] = a.unionByName(
        a.limit(1).withColumn("variant", F.when(F.col("variant") == "control", "treatment").otherwise("control")))
    res = _status(validate(t))
    assert res["dim_users.primary_key_unique"] == ("FAIL", "1")
    assert res["match_events.xg_range"][0] == "FAIL"
    assert res["app_events.user_fk"] == ("FAIL", "1")
    assert res["app_events.match_fk"] == ("FAIL", "1")
    assert res["content.match_fk"] == ("PASS", "0")
    assert res["experiment.no_crossover"] == ("FAIL", "1")
    assert res["fact_experiment_assignments.primary_key_unique"] == ("FAIL", "1")
    with pytest.raises(DataQualityError, match="app_events.user_fk=1"):
        assert_valid(t)


def test_missing_table_and_column(tables):
    t = dict(tables.items())
    del t["dim_teams"]
    t["dim_players"] = t["dim_players"].drop("team_name")
    t["fact_campaign_spend"] = t["fact_campaign_spend"].drop("campaign_id")
    res = _status(validate(t))
    assert res["dim_teams.present"] == ("FAIL", "0")
    assert "dim_teams.schema" not in res
    assert res["dim_players.schema"] == ("FAIL", "team_name")
    assert res["fact_campaign_spend.primary_key_unique"] == ("FAIL", "-1")


def test_null_keys_and_duplicates_count_nulls_equal(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k long")
    from fanpulse.operators.quality import key_stats
    r = key_stats(df, ["k"]).collect()[0]
    assert (r.duplicates, r.null_keys) == (2, 2)


def test_session_order_backwards(spark, tables):
    from fanpulse.operators.quality import backwards_in_order
    import datetime as dt
    rows = [(1, "s", dt.datetime(2024, 1, 1, 10)), (2, "s", dt.datetime(2024, 1, 1, 9)),
            (3, "s", dt.datetime(2024, 1, 1, 11)), (70000, "s", dt.datetime(2024, 1, 1, 8))]
    df = spark.createDataFrame(rows, "event_id long, session_id string, event_ts timestamp_ntz")
    for bucket in (None, F.floor(F.col("event_id") / 65536)):
        n = backwards_in_order(df, "session_id", "event_id", "event_ts", bucket).where("_back").count()
        assert n == 2


def test_mart_checks_reconcile(tables):
    res = {r.check_name: r for r in marts.mart_data_quality(tables, as_of="2024-02-01 00:00:00").collect()}
    assert len(res) == 5 and all(r.status == "PASS" for r in res.values())


def test_session_order_across_borders(spark):
    from fanpulse.operators.quality import backwards_count
    import random
    rng = random.Random(5)
    rows = [(i, "hot" if i % 3 == 0 else f"s{rng.randrange(40)}", rng.randrange(500) if i % 11 else None) for i in range(3000)]
    rows += [(5000 + i, None, -i) for i in range(50)] + [(None, f"lone{i}", i) for i in range(20)]
    last, expected = {}, 0
    for i, s, v in rows:
        if i is not None:
            p = last.get(s)
            expected += p is not None and v is not None and v < p
            last[s] = v
    df = spark.createDataFrame(rows, "event_id long, session_id string, v long")
    assert backwards_count(df, "session_id", "event_id", "v").first()[0] == expected > 500
    assert backwards_count(df.limit(0), "session_id", "event_id", "v").first()[0] == 0
    by_name = df.where("event_id is not null").withColumn("name", F.lpad(F.col("event_id").cast("string"), 6, "0"))
    assert backwards_count(by_name, "session_id", "name", "v").first()[0] == expected


def test_hot_session_is_split_over_tasks(spark):
    from fanpulse.operators import quality
    df = spark.range(60_000).select(F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("session_id"), F.col("id").alias("event_ts"))
    cuts = df.agg(F.percentile_approx("event_id", F.array(*[F.lit(k / 32) for k in range(1, 32)]), F.lit(1000)).alias("c")).first().c
    pieces = df.where("session_id = 'hot'").groupBy(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("event_id")))).count()
    assert pieces.count() == 32 and pieces.agg(F.max("count")).first()[0] < 20_000 / 16
    plan = quality.backwards_count(df, "session_id", "event_id", "event_ts")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_g" in plan and ", _p" in plan and quality.backwards_count(df, "session_id", "event_id", "event_ts").first()[0] == 0


def test_checks_over_empty_and_broken_tables(tables):
    t = dict(tables.items())
    t["fact_experiment_assignments"] = t["fact_experiment_assignments"].limit(0)
    t["dim_content"] = t["dim_content"].limit(0)
    res = _status(validate(t))
    assert len(res) == 39 and res["experiment.no_crossover"] == ("PASS", "0") and res["fact_experiment_assignments.primary_key_unique"] == ("PASS", "0")
    with_content = t["fact_app_events"].where("content_id is not null").count()
    assert res["app_events.content_fk"] == ("FAIL", str(with_content)) and res["content.match_fk"] == ("PASS", "0")


def test_scorecard_halves_its_shuffles(tables):
    from fanpulse.plans.registry import BUILDERS, _load_extensions
    _load_extensions()
    plan = BUILDERS["quality_scorecard"](tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 8  # the others move one row a task: bounds and counts of the bindings


def test_drill_matches_distinct_counts(spark, tables):
    from fanpulse.operators.engagement import engagement_drill
    rows = [(1, 5, "a", "view"), (1, 5, "a", "view"), (1, 70_000, "b", "subscription_start"), (2, 5, "a", "view"), (2, None, "a", "view"), (9, -3, "zz", "view"), (None, 5, None, "view")]
    ev = spark.createDataFrame(rows, "match_id long, user_id long, content_id string, event_name string")
    content = spark.createDataFrame([("a", "x"), ("b", "y")], "content_id string, content_type string")
    matches = spark.createDataFrame([(1, "L"), (2, "L")], "match_id long, competition_name string")
    got = {(r.level, r.competition_name, r.match_id, r.content_type): (r.views, r.unique_viewers, r.subscriptions) for r in engagement_drill(ev, content, matches).collect()}
    assert got[0, "L", 1, "x"] == (2, 1, 0) and got[0, "L", 1, "y"] == (1, 1, 1) and got[0, "L", 2, "x"] == (2, 1, 0) and got[0, None, 9, None] == (1, 1, 0)
    assert got[1, "L", 1, None] == (3, 2, 1) and got[3, "L", None, None] == (5, 2, 1) and got[3, None, None, None] == (2, 2, 0) and got[7, None, None, None] == (7, 3, 1)
    assert engagement_drill(ev.limit(0), content, matches).count() == 0
    plan = engagement_drill(*[tables[n] for n in ("fact_app_events", "dim_content", "dim_matches")])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
