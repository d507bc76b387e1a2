from conftest import app_events
from pyspark.sql import functions as F

from fanpulse.operators.experiment import ab_test_mart, ab_test_report, assign_variant, two_proportion_test


def test_published_goldens_two_proportion(spark):
    metrics = spark.createDataFrame(
        [("control", 12589, 1535, 1535 / 12589, 0.0, 0.0), ("treatment", 12411, 1956, 1956 / 12411, 0.0, 0.0)],
        "variant string, users long, converted_users long, conversion_rate double, avg_match_center_views double, arpu_usd double")
    r = two_proportion_test(metrics).collect()[0]
    assert round(r.control_rate, 6) == 0.121932 and round(r.treatment_rate, 6) == 0.157602
    assert round(r.absolute_lift, 6) == 0.035670 and round(r.relative_lift, 6) == 0.292543
    assert round(r.ci_95_lower, 6) == 0.027082 and round(r.ci_95_upper, 6) == 0.044259
    assert abs(r.z_score - 8.135617392294254) < 1e-5 and r.significant_at_95pct


def _assignments(spark):
    return spark.createDataFrame(
        [(1, "match_center_v2", "control", None), (2, "match_center_v2", "control", None),
         (3, "match_center_v2", "treatment", None), (4, "match_center_v2", "treatment", None)],
        "user_id long, experiment_name string, variant string, assigned_at timestamp_ntz")


def test_users_without_events_sql_vs_report(spark):
    ev = app_events(spark, [
        (1, 1, "2024-01-01 10:00:00", "subscription_start"),
        (2, 3, "2024-01-01 10:00:00", "match_center_view"),
        (3, 4, "2024-01-01 10:00:00", "subscription_start"),
    ])  # user 2 has no events
    m = ab_test_mart(_assignments(spark), ev).collect()[0]
    assert m.control_users == 2 and m.control_converted == 1
    assert m.control_rate == 1.0          # NULL converted leaves the AVG denominator
    assert m.control_arpu == round(9.99 / 2, 6)   # SQL: revenue 0 averaged in
    rep = {r.variant: r for r in ab_test_report(_assignments(spark), ev).collect()}
    assert rep["control"].users == 2 and rep["control"].arpu_usd == 9.99  # report: skip-NULL
    assert rep["treatment"].conversion_rate == 0.5


def test_assign_variant_is_stable_and_balanced(tables):
    users = tables["dim_users"]
    a = assign_variant(users, "exp")
    b = assign_variant(users, "exp")
    assert a.exceptAll(b).count() == 0
    counts = {r.variant: r["count"] for r in a.groupBy("variant").count().collect()}
    total = sum(counts.values())
    assert set(counts) == {"control", "treatment"} and abs(counts["control"] / total - 0.5) < 0.1
    assert a.groupBy("user_id").agg(F.count_distinct("variant").alias("n")).where("n > 1").count() == 0


def test_assigned_denominator_counts_inactive_users(spark):
    ev = app_events(spark, [(1, 1, "2024-01-01 10:00:00", "subscription_start"),
                            (2, 3, "2024-01-01 10:00:00", "subscription_start")])
    sql = ab_test_mart(_assignments(spark), ev).collect()[0]
    assigned = ab_test_mart(_assignments(spark), ev, denominator="assigned").collect()[0]
    assert sql.control_rate == 1.0 and assigned.control_rate == 0.5
    assert sql.control_users == assigned.control_users == 2
