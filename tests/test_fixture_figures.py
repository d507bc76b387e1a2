"""Figures that FIXTURES.md §4 reports for the test-data bindings (obtained
independently in DuckDB), reproduced by the Spark operators on sf0.001."""

from pyspark.sql import functions as F

from fanpulse.operators.experiment import user_outcomes
from fanpulse.operators.football import interval_counts, key_moments
from fanpulse.plans import marts
from fanpulse.plans.registry import conversion_on_test_data


def test_retention_and_funnel_figures(tables):
    r = marts.mart_retention_cohort(tables)
    assert r.count() == 104
    assert tuple(r.agg(F.sum("retained_d1"), F.sum("retained_d7"), F.sum("retained_d30")).first()) == (4, 9, 11)
    steps = ["user_match_journeys", "notification_users", "match_center_users", "highlight_users", "subscription_users"]
    f = marts.mart_conversion_funnel(tables).agg(*[F.sum(c) for c in steps]).first()
    assert tuple(f) == (120, 96, 39, 13, 1)


def test_experiment_figures(tables):
    o = user_outcomes(tables["fact_experiment_assignments"], tables["fact_app_events"], "match_center_v2",
                      conversion_on_test_data())
    rows = o.groupBy("variant").agg(F.count("*").alias("n"), F.count_if(F.col("has_events")).alias("active"),
                                    F.avg(F.col("converted").cast("int")).alias("rate")).orderBy("variant").collect()
    assert [(r.n, r.active) for r in rows] == [(75, 8), (75, 7)]
    assert round(rows[0].rate, 3) == 0.375 and round(rows[1].rate, 3) == 0.571


def test_moment_spend_and_group_figures(tables):
    me = tables["fact_match_events"]
    assert key_moments(me).count() == 531 and key_moments(me, all_shots=True).count() == 684
    mo = key_moments(me).select("event_id", "match_id", "event_ts")
    ev = tables["fact_app_events"].select("match_id", "event_ts", "event_id")
    pairs = interval_counts(mo, ev, "match_id", "event_ts", "event_ts", 5, 5,
                            aggs=[F.count("_e_event_id").alias("n")]).agg(F.sum("n")).first()[0]
    assert pairs == 11
    spend = marts.mart_marketing_economics(tables)
    assert spend.count() == 90 and spend.where("new_users = 0").count() == 25
    assert marts.mart_sports_engagement(tables).count() == 40
