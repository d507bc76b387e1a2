"""Registered round trips of the sinks: layouts, replays, bucketed joins, manifests, exports.

Each query writes canonical tables to a folder of its own below the session's checkpoint folder and returns what a reader of the
committed result sees. Unlike other queries, building one starts the writing jobs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanpulse.operators import experiment, marketing
from fanpulse.plans import reports
from fanpulse.plans.oracle import SQL
from fanpulse.plans.oracle_bindings import with_tables
from fanpulse.plans.registry import register
from fanpulse.schemas import LAYOUT, TABLES
from fanpulse.session import ensure_checkpoint_dir
from fanpulse.sources import bucketed, io

REPLAYED = "2023-12-27"  # a spend date of the test data
SAMPLE = 5000


def scratch(t) -> str:
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/layout-{uuid.uuid4().hex}"


def written(t, *names: str) -> str:
    path = scratch(t)
    io.write_with_layout({n: t[n] for n in names}, path)
    return path


def weekend_activity(events: DataFrame, dates: DataFrame) -> DataFrame:
    """Activity of the weekend dates. Over a table laid out by date, the chosen dates prune the folders at run time (Spark
    takes a comparison as selective, a bare boolean column not)."""
    chosen = dates.where(F.col("day_name").isin("Saturday", "Sunday")).select(F.col("date").alias("event_date"), "iso_week")
    return events.join(chosen, "event_date").groupBy("iso_week").agg(
        F.count("event_id").alias("events"), F.count_distinct("user_id").alias("users"), F.sum("revenue_usd").alias("revenue_usd"))


def layout_weekend_activity(t) -> DataFrame:
    path = written(t, "fact_app_events", "dim_date")
    events, dates = (io.read_layout_table(t.spark, path, n) for n in ("fact_app_events", "dim_date"))
    return weekend_activity(events, dates)


register("layout_weekend_activity", with_tables(["app_events", "dim_date"], """
SELECT d.iso_week, COUNT(e.event_id) AS events, COUNT(DISTINCT e.user_id) AS users, ROUND(SUM(e.revenue_usd), 6) AS revenue_usd
FROM app_events e JOIN dim_date d ON d.date = e.event_date WHERE d.is_weekend GROUP BY d.iso_week"""))(layout_weekend_activity)


def layout_day_range(t) -> DataFrame:
    """Shots of two days, from the folders of those days only; type and match prune row groups inside them."""
    path = written(t, "fact_match_events")
    rows = io.day_range(t.spark, path, "fact_match_events", "2024-01-01", "2024-01-02")
    return rows.where("event_type = 'Shot'").groupBy("match_id").agg(F.count("*").alias("shots"), F.sum("shot_xg").alias("xg"))


register("layout_day_range", with_tables(["match_events"], """
SELECT match_id, COUNT(*) AS shots, ROUND(SUM(shot_xg), 6) AS xg FROM match_events
WHERE event_type = 'Shot' AND CAST(event_ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-02' GROUP BY match_id"""))(layout_day_range)


def layout_replayed_day(t) -> DataFrame:
    """One date is replayed from the table's own rows with doubled spend; the reader sees it beside all other dates."""
    path, name = written(t, "fact_campaign_spend"), "fact_campaign_spend"
    own = io.read_layout_table(t.spark, path, name)
    io.replace_dates(own.where(F.col("spend_date") == F.lit(REPLAYED).cast("date")).withColumn("spend_usd", F.col("spend_usd") * 2), path, name)
    return io.read_layout_table(t.spark, path, name).groupBy("channel").agg(
        F.count("*").alias("days"), F.sum("clicks").alias("clicks"), F.sum("spend_usd").alias("spend_usd"))


register("layout_replayed_day", with_tables(["campaign_spend"], f"""
SELECT channel, COUNT(*) AS days, CAST(SUM(clicks) AS BIGINT) AS clicks,
  ROUND(SUM(CASE WHEN spend_date = DATE '{REPLAYED}' THEN 2 * spend_usd ELSE spend_usd END), 6) AS spend_usd
FROM campaign_spend GROUP BY channel"""))(layout_replayed_day)


def layout_table_manifest(t) -> DataFrame:
    return io.layout_manifest(t.spark, written(t, *TABLES), TABLES)


def _manifest_sql() -> str:
    rows = []
    for name in TABLES:
        source, spec = reports.ORACLE_NAME[name], LAYOUT[name]
        missing = " OR ".join(f"{k} IS NULL" for k in reports.PRIMARY_KEYS[name])
        part = f"CAST({spec['partition']} AS DATE)" if spec.get("partition") else "1"
        rows.append(f"SELECT '{name}' AS \"table\", CAST(1 AS BIGINT) AS version, COUNT(*) AS rows, COUNT(*) FILTER (WHERE {missing}) AS null_keys, COUNT(DISTINCT {part}) AS folders FROM {source}")
    return "\nUNION ALL ".join(rows)


register("layout_table_manifest", with_tables(list(reports.ORACLE_NAME.values()), _manifest_sql()))(layout_table_manifest)


# ============================================================== bucketed joins
def bucketed_user_economics(t) -> DataFrame:
    """M8 over users and events in buckets by user: the revenue of a user meets the user without an exchange of either."""
    users, events = bucketed.stored(t.spark, scratch(t), {"dim_users": t["dim_users"], "fact_app_events": t["fact_app_events"]}, "user_id")
    return marketing.unit_economics(users, events, t["fact_campaign_spend"])


def bucketed_ab_test(t) -> DataFrame:
    """M9 by the contract (a subscription start converts) over assignments and events in buckets by user."""
    tables = {n: t[n] for n in ("fact_experiment_assignments", "fact_app_events")}
    assigned, events = bucketed.stored(t.spark, scratch(t), tables, "user_id")
    return experiment.ab_test_mart(assigned, events)


def by_contract(sql: str) -> str:
    """The SQL with the conversion of the contract: any subscription start."""
    return sql.replace("(e.event_name = 'subscription_start' AND e.value > 150)", "(e.event_name = 'subscription_start')").replace(
        "bool_or(event_name = 'subscription_start' AND value > 150)", "bool_or(event_name = 'subscription_start')")


register("bucketed_user_economics", SQL["mart_marketing_economics"])(bucketed_user_economics)
register("bucketed_ab_test", by_contract(SQL["mart_ab_test_match_center_v2"]))(bucketed_ab_test)
register("report_ab_test_by_contract", by_contract(SQL["report_ab_test"]))(lambda t: reports.r6_(t))
register("summary_kpis_by_contract", by_contract(SQL["summary_kpis"]))(lambda t: reports.r10(t))
register("experiment_decision_by_contract", by_contract(SQL["experiment_decision"]))(lambda t: reports.d7(t))


# ============================================================== files for others
def exported_campaign_targets(t) -> DataFrame:
    path = scratch(t)
    io.export_campaign_targets(t["fact_campaign_spend"], path)
    return t.spark.read.option("header", True).schema("spend_date date, channel string, target_spend_usd double").csv(path)


register("exported_campaign_targets", with_tables(["campaign_spend"], "SELECT CAST(spend_date AS TIMESTAMP) AS spend_date, channel, target_spend_usd FROM campaign_spend"))(
    lambda t: exported_campaign_targets(t).withColumn("spend_date", F.col("spend_date").cast("timestamp_ntz")))


def exported_event_sample(t) -> DataFrame:
    path = scratch(t)
    io.export_event_sample(t["fact_app_events"], path, SAMPLE)
    return t.spark.read.options(**io.CSV).schema(t["fact_app_events"].schema).csv(path).select("event_id", "user_id", "event_ts", "event_name", "match_id", "revenue_usd")


register("exported_event_sample", with_tables(["app_events"], f"""
SELECT event_id, user_id, event_ts, event_name, match_id, revenue_usd FROM app_events ORDER BY event_id LIMIT {SAMPLE}"""))(exported_event_sample)


def exported_funnel(t) -> DataFrame:
    """A report extract as CSV, read back."""
    path, rows = scratch(t), reports.r3(t)
    io.export_extracts({"funnel": rows}, path)
    return t.spark.read.options(**io.CSV).schema(rows.schema).csv(f"{path}/funnel")


register("exported_funnel", SQL["report_funnel"])(exported_funnel)


def target_sheet_blend(t) -> DataFrame:
    """D6 with the targets from the sheet's CSV form instead of a frame in memory."""
    path = scratch(t)
    marketing.campaign_targets(t.spark).coalesce(1).write.option("header", True).csv(path)
    return marketing.target_blend(reports.r5(t), io.read_campaign_targets(t.spark, path))


register("target_sheet_blend", SQL["target_blend"])(target_sheet_blend)


# chart -> (label, value) fields of an entry
CHARTED = {"executive_daily": ("event_date", "dau"), "sports": ("match_label", "unique_viewers"), "marketing": ("channel", "spend_usd")}


def insights_charts(t) -> DataFrame:
    """Charts of the written insights document: every entry at its place."""
    path, daily, economics = scratch(t), reports.r1(t), reports.r5(t)
    charts = {"executive_daily": (daily, ["event_date"]), "sports": (reports.r9(t), [-F.col("unique_viewers"), "match_label"]), "marketing": (economics, ["channel"])}
    io.write_insights_document(reports.r12(t), reports.r12(t), charts, {"best_channel": reports.r11_best_channel(t)}, path)

    def field(i: int):
        return F.coalesce(*[F.when(F.col("chart") == name, F.get_json_object("entry", f"$.{of[i]}")) for name, of in CHARTED.items()])

    return io.read_insights(t.spark, path).select("chart", "position", "of", field(0).alias("label"), field(1).cast("double").alias("value"))


def _charts_sql() -> str:
    parts = {"executive_daily": ("report_executive_daily", "CAST(CAST(event_date AS DATE) AS VARCHAR)", "event_date"),
             "sports": ("match_rollup", "match_label", "unique_viewers DESC, match_label"), "marketing": ("report_marketing", "channel", "channel")}
    return "\nUNION ALL ".join(
        f"SELECT '{chart}' AS chart, ROW_NUMBER() OVER (ORDER BY {order}) - 1 AS position, COUNT(*) OVER () AS of, {label} AS label, ROUND(CAST({CHARTED[chart][1]} AS DOUBLE), 6) AS value FROM ({SQL[query]}) AS q"
        for chart, (query, label, order) in parts.items())


register("insights_charts", _charts_sql())(insights_charts)
