"""Report extracts (R*), dashboard queries (D*) and helper operators (G*).

Each query is registered with its builder over the canonical tables and,
where SQL-expressible, its DuckDB oracle. Report queries reuse the operator
library with the report's option arguments (grain, entry events, window
bounds, denominators), so the two definitions of a metric stay separate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanpulse.functions.joins import unique_by
from fanpulse.functions.scalar import campaign_key, count_if, safe_divide
from fanpulse.operators import engagement, experiment, football, marketing, quality
from fanpulse.operators.experiment import assign_variant, event_conversion_rate
from fanpulse.plans import marts
from fanpulse.plans.oracle import _COHORT, _FUNNEL_MART, _MART_CHECKS, _USER_DAYS, AS_OF, funnel_sql, r6, sdiv
from fanpulse.plans.oracle_bindings import with_tables
from fanpulse.plans.registry import register, conversion_on_test_data
from fanpulse.schemas import CONTRACTS, PAID_CHANNELS, PRIMARY_KEYS

# canonical table name -> oracle CTE name
ORACLE_NAME = {
    "dim_date": "dim_date", "dim_users": "dim_users", "dim_matches": "dim_matches", "dim_teams": "dim_teams",
    "dim_players": "dim_players", "dim_content": "dim_content", "fact_match_events": "match_events",
    "fact_app_events": "app_events", "fact_campaign_spend": "campaign_spend",
    "fact_experiment_assignments": "assignments",
}


# ============================================================== Spark builders
def r1(t):
    return engagement.executive_daily(t["fact_app_events"]).orderBy("event_date")


def r2(t):
    users = t["dim_users"].select("user_id", "signup_date", "acquisition_channel", "platform")
    return engagement.cohort_retention(unique_by(users, ["user_id"], "users"), t["fact_app_events"], by_cohort_date=False)


def r3(t):
    return engagement.funnel_report(t["fact_app_events"])


def r4(t):
    return football.sports_report(t["fact_app_events"], t["dim_content"], t["fact_match_events"], t["dim_matches"])


def r5(t):
    return marketing.channel_economics(t["dim_users"], t["fact_app_events"], t["fact_campaign_spend"])


def r6_(t, conversion=None):
    return experiment.ab_test_report(t["fact_experiment_assignments"], t["fact_app_events"], conversion=conversion)


def r7(t, keep_id=False):
    return football.key_moments_report(t["fact_match_events"], t["fact_app_events"], t["dim_matches"], keep_id=keep_id)


def r8(t, as_of=None):
    """``as_of``: the time of the check, now if not given. Ids may be of any type."""
    return quality.with_checked_at(quality.validate(t), as_of)


def match_rollup(sports_rows: DataFrame, by: str = "match_label") -> DataFrame:
    """Per match: widest content-type reach (max, not a distinct count across
    types), total views and subscriptions, xG. ``by='match_label'`` follows the
    extract (a repeated pairing merges); ``by='match_id'`` keeps matches apart."""
    keys = ["match_label"] if by == "match_label" else ["match_id", "match_label"]
    return sports_rows.groupBy(*keys).agg(
        F.max("unique_viewers").alias("unique_viewers"), F.sum("views").alias("views"),
        F.sum("subscriptions").alias("subscriptions"), F.max("xg").alias("xg"),
    ).orderBy(F.desc("unique_viewers"), *keys)


def r9(t):
    return match_rollup(r4(t))


def r10(t, conversion=None):
    daily = r1(t).select(
        F.col("dau").alias("_dau"), F.col("mau").alias("_mau"), F.col("revenue_usd").alias("_rev"),
        F.col("active_viewers").alias("_av"), *[F.lit(None).cast("double").alias(c) for c in ("_rl", "_lo", "_hi")],
    )
    ab = r6_(t, conversion).where(F.col("variant") == "treatment").select(
        *[F.lit(None).cast(tp).alias(c) for c, tp in (("_dau", "long"), ("_mau", "long"), ("_rev", "double"), ("_av", "long"))],
        F.col("relative_lift").alias("_rl"), F.col("ci_95_lower").alias("_lo"), F.col("ci_95_upper").alias("_hi"),
    )
    both = daily.unionByName(ab)
    return both.agg(
        F.max("_dau").alias("peak_dau"), F.max("_mau").alias("mau"),
        F.round(F.sum("_rev"), 2).alias("total_revenue_usd"), F.sum("_av").alias("active_viewers"),
        F.round(F.max("_rl"), 4).alias("ab_relative_lift"), F.round(F.max("_lo"), 4).alias("ab_ci_lower"),
        F.round(F.max("_hi"), 4).alias("ab_ci_upper"),
    )


def r11_top_match(t):
    return r9(t).limit(1)


def r11_best_channel(t):
    return r5(t).orderBy(F.desc_nulls_last("roas_30d"), "channel").limit(1)


def r11_top_moment(t):
    goals = r7(t, keep_id=True).where(F.col("shot_outcome") == "Goal")
    return goals.orderBy(F.desc("app_events_plus_minus_5m"), "match_id", "event_id").limit(1).drop("event_id")


def r12(t):
    parts = [("app_events", "fact_app_events"), ("match_events", "fact_match_events"), ("users", "dim_users"),
             ("matches", "dim_matches")]
    counts = None
    for out, table in parts:
        c = t[table].agg(F.count(F.lit(1)).alias("_n")).select(F.lit(out).alias("_k"), "_n")
        counts = c if counts is None else counts.unionByName(c)
    return counts.agg(*[F.sum(F.when(F.col("_k") == out, F.col("_n"))).alias(out) for out, _ in parts])


_STEP_LABELS = (("Notification", "notification_users"), ("Match center", "match_center_users"),
                ("Highlight", "highlight_users"), ("Subscription", "subscription_users"))


def funnel_steps(funnel_rows: DataFrame, platform: str = "all", variant: str = "treatment") -> DataFrame:
    """Step totals of one variant (all or one platform) and each step's share of
    the first step, from report-funnel rows."""
    rows = funnel_rows.where(F.col("experiment_variant") == variant)
    if platform != "all":
        rows = rows.where(F.col("platform") == platform)
    sums = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for _, c in _STEP_LABELS])
    first = _STEP_LABELS[0][1]
    steps = F.array(*[
        F.struct(F.lit(label).alias("step"), F.col(c).alias("users"),
                 safe_divide(c, first).alias("share_of_first"))
        for label, c in _STEP_LABELS
    ])
    return sums.select(F.inline(steps))


def weighted_retention(retention_rows: DataFrame, days=(1, 7, 30)) -> DataFrame:
    """Cohort-size-weighted retention per day over report-retention rows."""
    w = retention_rows.agg(*[
        safe_divide(F.sum(F.col(f"retention_d{d}") * F.col("cohort_size")), F.sum("cohort_size")).alias(f"_d{d}")
        for d in days])
    arr = F.array(*[F.struct(F.lit(d).alias("day"), F.col(f"_d{d}").alias("retention")) for d in days])
    return w.select(F.inline(arr))


def retention_by_channel(retention_rows: DataFrame) -> DataFrame:
    return retention_rows.groupBy("acquisition_channel").agg(
        safe_divide(F.sum(F.col("retention_d30") * F.col("cohort_size")), F.sum("cohort_size")).alias("retention_d30")
    ).orderBy(F.desc("retention_d30"), "acquisition_channel")


def d1(t, platform: str = "all", variant: str = "treatment"):
    return funnel_steps(r3(t), platform, variant)


def d2(t):
    return weighted_retention(r2(t))


def d3(t):
    return retention_by_channel(r2(t))


def d4(t):
    return marketing.marketing_decision(r5(t))


def d5(t, metric: str | None = None):
    metrics = (("DAU", "dau"), ("Active Viewers", "active_viewers"), ("Revenue", "revenue_usd"), ("ARPU", "arpu_usd"))
    wide = r1(t).select("event_date", *[F.col(c).cast("double").alias(label) for label, c in metrics])
    long = wide.unpivot("event_date", [label for label, _ in metrics], "metric", "value")
    return long if metric is None else long.where(F.col("metric") == metric)


def d6(t):
    return marketing.target_blend(r5(t), marketing.campaign_targets(t["fact_app_events"].sparkSession))


def d7(t, conversion=None):
    return experiment.experiment_decision(marts.experiment.ab_test_mart(
        t["fact_experiment_assignments"], t["fact_app_events"], conversion=conversion))


def d8(t):
    shots = t["fact_match_events"].where(F.col("event_type") == "Shot")
    players = t["dim_players"].select("player_id", "player_name")
    return shots.join(players, "player_id", "left").select(
        "match_id", "event_id", "x", "y", "shot_outcome", "shot_xg", "player_name")


def d9(t):
    rows = marts.mart_retention_cohort(t)
    g = rows.groupingSets([["platform"], ["acquisition_channel"]], "platform", "acquisition_channel").agg(
        F.sum("retained_d30").alias("_r"), F.sum("cohort_size").alias("_n"))
    return g.select("platform", "acquisition_channel", (F.lit(1.0) - safe_divide("_r", "_n")).alias("churn_d30"))


_SCORE_GROUPS = (
    ("duplicate_keys", ("%.primary_key_unique", "fact_app_events.duplicate_event_id")),
    ("variant_crossover", ("experiment.no_crossover", "experiment.variant_crossover")),
    ("unknown_users", ("app_events.user_fk", "app_events.unknown_user")),
    ("fk_gaps", ("*_fk", "app_events.unknown_user")),
    ("invalid_xg", ("match_events.xg_range", "fact_match_events.invalid_xg")),
    ("reconciliation", ("product_daily.revenue_reconciliation",)),
)


def d10(t, max_lag_days: int = 2):
    """Scorecard groups over the contract suite and the mart checks, which share
    one tagged stream (``quality.suite_and_mart_checks``); every check row is
    tagged with all its groups (array + explode)."""
    allc = quality.suite_and_mart_checks(t, marts.mart_product_daily(t)).withColumnRenamed("suite", "_suite")
    tags = [F.when(F.col("_suite"), F.lit("quality_checks"))]
    for name, patterns in _SCORE_GROUPS:
        cond = None
        for p in patterns:
            c = F.col("check_name").endswith(p[1:]) if p.startswith("*") else F.col("check_name").like(p)
            cond = c if cond is None else (cond | c)
        tags.append(F.when(cond, F.lit(name)))
    allc = allc.repartition(1)  # a row per check, some fifty whatever the data
    tagged = allc.select("*", F.explode(F.array_compact(F.array(*tags))).alias("check_group"))
    groups = tagged.groupBy("check_group").agg(
        count_if(F.col("status") == "PASS").alias("passed"), F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(F.greatest(F.col("observed"), F.lit(0))), F.lit(0)).alias("observed"),
    )
    return groups.unionByName(freshness(t["fact_app_events"], AS_OF, max_lag_days))


def freshness(events: DataFrame, as_of: str, max_lag_days: int = 2) -> DataFrame:
    """Freshness tile: days from the latest event date to the as-of date."""
    lag = F.datediff(F.lit(as_of).cast("date"), F.max("event_date"))
    return events.agg(lag.cast("long").alias("observed")).select(
        F.lit("freshness").alias("check_group"),
        F.when(F.col("observed") <= max_lag_days, 1).otherwise(0).cast("long").alias("passed"),
        F.lit(1).cast("long").alias("total"), "observed",
    )


def d11(t):
    g = engagement.engagement_drill(t["fact_app_events"], t["dim_content"], t["dim_matches"])
    # match_id is a drill label here (NULL on the competition and total levels):
    # emitted as text so NULL-able ids never turn into floats downstream
    return g.withColumn("match_id", F.col("match_id").cast("string"))


def d12(t, start: str | None = None, end: str | None = None):
    rows = r1(t)
    if start:
        rows = rows.where(F.col("event_date") >= F.lit(start).cast("date"))
    if end:
        rows = rows.where(F.col("event_date") <= F.lit(end).cast("date"))
    return rows.agg(
        F.avg("dau").alias("dau"), F.max("mau").alias("mau"), F.avg("stickiness").alias("stickiness"),
        safe_divide(F.sum("subscriptions"), F.sum("dau")).alias("conversion"),
        safe_divide(F.sum("revenue_usd"), F.sum("dau")).alias("arpu_usd"),
        F.sum("active_viewers").alias("active_viewers"),
    )


def g1(t):
    return t["dim_date"]


def g2(t):
    return assign_variant(t["dim_users"], "match_center_v2")


def g3(t):
    return football.session_anchor_audit(t["fact_app_events"], t["fact_match_events"])


def g4(t):
    return event_conversion_rate(t["fact_app_events"])


def g5(t):
    ev = t["fact_app_events"].select(
        "campaign_id", campaign_key("acquisition_channel", "event_date", PAID_CHANNELS).alias("_k"))
    spend = t["fact_campaign_spend"].select(F.col("campaign_id").alias("_sk")).distinct()
    j = ev.join(spend, F.col("campaign_id") == F.col("_sk"), "left")
    return j.agg(
        count_if(F.col("campaign_id").isNotNull()).alias("paid_events"),
        count_if(F.col("campaign_id").isNotNull() & F.col("_sk").isNotNull()).alias("matched_spend_rows"),
        count_if(~F.col("campaign_id").eqNullSafe(F.col("_k"))).alias("key_mismatches"),
    )


def q_props(t):
    daily = marts.mart_product_daily(t)
    funnel = marts.mart_conversion_funnel(t)
    return quality.mart_property_checks(t["fact_app_events"], daily, funnel)


# ============================================================== oracle SQL pieces
_EXEC_DAILY = """
, daily AS (
  SELECT event_date, COUNT(DISTINCT user_id) AS dau, COUNT(DISTINCT session_id) AS sessions, COUNT(event_id) AS events,
    COUNT(*) FILTER (WHERE event_name = 'subscription_start') AS subscriptions,
    COUNT(*) FILTER (WHERE event_name = 'subscription_cancel') AS cancellations,
    SUM(revenue_usd) AS revenue_usd,
    COUNT(DISTINCT CASE WHEN event_name IN ('match_center_view', 'highlight_view') THEN user_id END) AS active_viewers
  FROM app_events GROUP BY event_date),
ud AS (SELECT DISTINCT event_date, user_id FROM app_events),
mau AS (
  SELECT d.event_date, COUNT(DISTINCT u.user_id) AS mau
  FROM daily d JOIN ud u ON u.event_date BETWEEN d.event_date - INTERVAL 29 DAY AND d.event_date
  GROUP BY d.event_date),
executive AS (
  SELECT d.event_date, dau, sessions, events, subscriptions, cancellations, ROUND(revenue_usd, 6) AS revenue_usd,
    active_viewers, mau, """ + r6(sdiv("dau", "mau")) + """ AS stickiness,
    """ + r6(sdiv("revenue_usd", "dau")) + """ AS arpu_usd,
    """ + r6(sdiv("subscriptions", "dau")) + """ AS subscription_conversion
  FROM daily d JOIN mau m ON d.event_date = m.event_date)
"""

_RETENTION = """
, activity AS (SELECT DISTINCT user_id, event_date FROM app_events),
joined AS (
  SELECT a.user_id, u.acquisition_channel, u.platform, date_diff('day', u.signup_date, a.event_date) AS dn
  FROM activity a JOIN dim_users u ON a.user_id = u.user_id),
sizes AS (SELECT acquisition_channel, platform, COUNT(DISTINCT user_id) AS cohort_size FROM dim_users GROUP BY 1, 2),
ret AS (
  SELECT acquisition_channel, platform, COUNT(DISTINCT CASE WHEN dn = 1 THEN user_id END) AS d1,
    COUNT(DISTINCT CASE WHEN dn = 7 THEN user_id END) AS d7, COUNT(DISTINCT CASE WHEN dn = 30 THEN user_id END) AS d30
  FROM joined GROUP BY 1, 2),
retention AS (
  SELECT s.acquisition_channel, s.platform, s.cohort_size,
    COALESCE(r.d1, 0) AS retained_d1, """ + r6(sdiv("COALESCE(r.d1, 0)", "s.cohort_size")) + """ AS retention_d1,
    COALESCE(r.d7, 0) AS retained_d7, """ + r6(sdiv("COALESCE(r.d7, 0)", "s.cohort_size")) + """ AS retention_d7,
    COALESCE(r.d30, 0) AS retained_d30, """ + r6(sdiv("COALESCE(r.d30, 0)", "s.cohort_size")) + """ AS retention_d30,
    ROUND(1 - """ + sdiv("COALESCE(r.d30, 0)", "s.cohort_size") + """, 6) AS churn_d30
  FROM sizes s LEFT JOIN ret r ON s.acquisition_channel IS NOT DISTINCT FROM r.acquisition_channel
    AND s.platform IS NOT DISTINCT FROM r.platform)
"""

_FUNNEL_REPORT = funnel_sql("funnel", "platform, experiment_variant", "journeys", known_keys=True)

_SPORTS = """
, typed AS (
  SELECT match_id, user_id, session_id, event_name, revenue_usd,
    (SELECT c.content_type FROM dim_content c WHERE c.content_id = a.content_id) AS content_type
  FROM app_events a),
pitch AS (
  SELECT match_id, COUNT(*) FILTER (WHERE event_type = 'Shot') AS shots, COUNT(*) FILTER (WHERE (event_type, shot_outcome) = ('Shot', 'Goal')) AS goals,
    COALESCE(SUM(shot_xg), 0) AS xg, COUNT(*) FILTER (WHERE event_type = 'Pass') AS passes, COUNT(*) FILTER (WHERE duel_type = 'Tackle') AS tackles
  FROM match_events WHERE period < 5 GROUP BY match_id),
sports AS (
  SELECT t.match_id, t.content_type, COUNT(*) AS views, COUNT(DISTINCT t.user_id) AS unique_viewers,
    COUNT(DISTINCT t.session_id) AS sessions, COUNT(*) FILTER (WHERE t.event_name = 'subscription_start') AS subscriptions,
    ROUND(SUM(t.revenue_usd), 6) AS revenue_usd, p.shots, p.goals, ROUND(p.xg, 6) AS xg, p.passes, p.tackles,
    m.match_date, m.kick_off, m.competition_id, m.competition_name, m.season_id, m.season_name, m.home_team_id,
    m.home_team_name, m.away_team_id, m.away_team_name, m.home_score, m.away_score,
    """ + r6(sdiv("COUNT(*) FILTER (WHERE t.event_name = 'subscription_start')", "COUNT(DISTINCT t.user_id)")) + """ AS viewer_conversion_rate,
    concat_ws(' vs ', m.home_team_name, m.away_team_name) AS match_label
  FROM typed t JOIN pitch p USING (match_id) JOIN dim_matches m USING (match_id) GROUP BY ALL)
"""

_MARKETING = """
, totals AS (
  SELECT channel, CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
    CAST(SUM(installs) AS BIGINT) AS installs, SUM(spend_usd) AS spend_usd, SUM(target_spend_usd) AS target_spend_usd
  FROM campaign_spend GROUP BY channel),
counts AS (SELECT acquisition_channel AS channel, COUNT(DISTINCT user_id) AS n FROM dim_users GROUP BY 1),
rev AS (
  SELECT u.acquisition_channel AS channel, SUM(e.revenue_usd) AS r
  FROM app_events e JOIN dim_users u ON e.user_id = u.user_id
  WHERE date_diff('day', u.signup_date, e.event_date) BETWEEN 0 AND 30 GROUP BY 1),
marketing AS (
  SELECT t.channel, impressions, clicks, installs, ROUND(spend_usd, 6) AS spend_usd,
    ROUND(target_spend_usd, 6) AS target_spend_usd, COALESCE(c.n, 0) AS new_users,
    ROUND(COALESCE(rv.r, 0), 6) AS revenue_30d,
    """ + r6(sdiv("spend_usd", "COALESCE(c.n, 0)")) + """ AS cac_usd,
    """ + r6(sdiv("COALESCE(rv.r, 0)", "COALESCE(c.n, 0)")) + """ AS ltv_30d_usd,
    """ + r6(sdiv("COALESCE(rv.r, 0)", "spend_usd")) + """ AS roas_30d,
    """ + r6(sdiv("clicks", "impressions")) + """ AS ctr,
    """ + r6(sdiv("installs", "clicks")) + """ AS install_rate
  FROM totals t LEFT JOIN counts c ON t.channel = c.channel LEFT JOIN rev rv ON t.channel = rv.channel)
"""

_AB_REPORT = """
, outcomes AS (
  SELECT user_id, bool_or(event_name = 'subscription_start' AND value > 150) AS converted,
    COUNT(*) FILTER (WHERE event_name = 'match_center_view') AS mcv, SUM(revenue_usd) AS rev
  FROM app_events GROUP BY user_id),
j AS (SELECT a.user_id, a.variant, o.converted, o.mcv, o.rev FROM assignments a LEFT JOIN outcomes o ON a.user_id = o.user_id),
m AS (
  SELECT variant, COUNT(DISTINCT user_id) AS users, COUNT(*) FILTER (WHERE converted) AS converted_users,
    AVG(CAST(converted AS INTEGER)) AS conversion_rate, AVG(mcv) AS avg_match_center_views, AVG(rev) AS arpu_usd
  FROM j GROUP BY variant),
s AS (
  SELECT MAX(CASE WHEN variant = 'control' THEN conversion_rate END) AS cr,
    MAX(CASE WHEN variant = 'treatment' THEN conversion_rate END) AS tr,
    MAX(CASE WHEN variant = 'control' THEN users END) AS cu, MAX(CASE WHEN variant = 'treatment' THEN users END) AS tu
  FROM m),
st AS (
  SELECT tr - cr AS absolute_lift, """ + sdiv("tr - cr", "cr") + """ AS relative_lift,
    tr - cr - 1.96 * sqrt(""" + sdiv("cr * (1 - cr)", "cu") + " + " + sdiv("tr * (1 - tr)", "tu") + """) AS lo,
    tr - cr + 1.96 * sqrt(""" + sdiv("cr * (1 - cr)", "cu") + " + " + sdiv("tr * (1 - tr)", "tu") + """) AS hi
  FROM s),
ab AS (
  SELECT m.variant, m.users, m.converted_users, ROUND(m.conversion_rate, 6) AS conversion_rate,
    ROUND(m.avg_match_center_views, 6) AS avg_match_center_views, ROUND(m.arpu_usd, 6) AS arpu_usd,
    ROUND(st.absolute_lift, 6) AS absolute_lift, ROUND(st.relative_lift, 6) AS relative_lift,
    ROUND(st.lo, 6) AS ci_95_lower, ROUND(st.hi, 6) AS ci_95_upper, NOT (st.lo <= 0 AND st.hi >= 0) AS significant_at_95pct
  FROM m, st)
"""

_MOMENTS_REPORT = """
, moments AS (
  SELECT * FROM match_events
  WHERE period <= 4 AND (event_type = 'Shot' OR event_type IN ('Substitution', 'Bad Behaviour'))),
windows AS (
  SELECT match_id, MIN(event_ts) - INTERVAL 30 MINUTE AS ws, MAX(event_ts) + INTERVAL 15 MINUTE AS we
  FROM match_events WHERE period <= 4 GROUP BY match_id),
base AS (
  SELECT w.match_id,
    CAST(COUNT(e.event_id) AS DOUBLE) / NULLIF(date_diff('microsecond', w.ws, w.we) / 60e6 / 10, 0) AS baseline_app_events_10m
  FROM windows w LEFT JOIN app_events e ON w.match_id = e.match_id AND e.event_ts >= w.ws AND e.event_ts < w.we
  GROUP BY w.match_id, w.ws, w.we),
counted AS (
  SELECT mo.event_id, mo.match_id, mo.minute, mo.event_type, mo.shot_outcome, mo.shot_xg, mo.team_id, mo.player_id,
    COUNT(e.event_id) AS app_events_plus_minus_5m
  FROM moments mo LEFT JOIN app_events e ON mo.match_id = e.match_id
    AND e.event_ts >= mo.event_ts - INTERVAL 5 MINUTE AND e.event_ts < mo.event_ts + INTERVAL 5 MINUTE
  GROUP BY mo.event_id, mo.match_id, mo.minute, mo.event_type, mo.shot_outcome, mo.shot_xg, mo.team_id, mo.player_id),
moments_report AS (
  SELECT c.match_id, c.minute, c.event_type, c.shot_outcome, c.shot_xg, c.team_id, c.player_id,
    c.app_events_plus_minus_5m, ROUND(b.baseline_app_events_10m, 6) AS baseline_app_events_10m,
    """ + r6(sdiv("c.app_events_plus_minus_5m", "b.baseline_app_events_10m")) + """ AS engagement_lift_vs_baseline,
    m.competition_name, m.home_team_name, m.away_team_name, m.home_team_name || ' vs ' || m.away_team_name AS match_label,
    c.event_id
  FROM counted c JOIN base b ON c.match_id = b.match_id JOIN dim_matches m ON c.match_id = m.match_id)
"""
_R7_COLS = ("match_id, minute, event_type, shot_outcome, shot_xg, team_id, player_id, app_events_plus_minus_5m, "
            "baseline_app_events_10m, engagement_lift_vs_baseline, competition_name, home_team_name, away_team_name, match_label")


def _quality_sql() -> str:
    """The 39-row contract suite in SQL (generated per contract table)."""
    parts = []
    for table, schema in CONTRACTS.items():
        v = ORACLE_NAME[table]
        keys = PRIMARY_KEYS[table]
        any_null = " OR ".join(f"{k} IS NULL" for k in keys)
        parts.append(f"SELECT '{table}.schema' AS check_name, 'complete' AS observed, 'complete' AS expected")
        parts.append(
            f"SELECT '{table}.primary_key_unique', CAST(COALESCE(SUM(c - 1), 0) AS VARCHAR), '0' "
            f"FROM (SELECT COUNT(*) AS c FROM {v} GROUP BY {', '.join(keys)}) g")
        parts.append(
            f"SELECT '{table}.primary_key_not_null', CAST(COUNT(*) FILTER (WHERE {any_null}) AS VARCHAR), '0' FROM {v}")
    parts += [
        "SELECT 'app_events.user_fk', CAST(COUNT(*) AS VARCHAR), '0' FROM app_events e "
        "WHERE NOT EXISTS (SELECT 1 FROM dim_users u WHERE u.user_id = e.user_id)",
        "SELECT 'app_events.date_fk', CAST(COUNT(*) AS VARCHAR), '0' FROM app_events e "
        "WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date = e.event_date)",
        "SELECT 'app_events.content_fk', CAST(COUNT(*) AS VARCHAR), '0' FROM app_events e "
        "WHERE e.content_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_content c WHERE c.content_id = e.content_id)",
        "SELECT 'content.match_fk', CAST(COUNT(*) AS VARCHAR), '0' FROM dim_content c "
        "WHERE NOT EXISTS (SELECT 1 FROM dim_matches m WHERE m.match_id = c.match_id)",
        "SELECT 'app_events.match_fk', CAST(COUNT(*) AS VARCHAR), '0' FROM app_events e "
        "WHERE NOT EXISTS (SELECT 1 FROM dim_matches m WHERE m.match_id = e.match_id)",
        "SELECT 'match_events.match_fk', CAST(COUNT(*) AS VARCHAR), '0' FROM match_events e "
        "WHERE NOT EXISTS (SELECT 1 FROM dim_matches m WHERE m.match_id = e.match_id)",
        "SELECT 'match_events.xg_range', CAST(COUNT(*) FILTER (WHERE shot_xg IS NOT NULL AND NOT (shot_xg BETWEEN 0 AND 1)) AS VARCHAR), '0' FROM match_events",
        "SELECT 'app_events.session_order', CAST(COUNT(*) FILTER (WHERE back) AS VARCHAR), '0' FROM "
        "(SELECT event_ts < LAG(event_ts) OVER (PARTITION BY session_id ORDER BY event_id) AS back FROM app_events) s",
        "SELECT 'experiment.no_crossover', CAST(COUNT(*) FILTER (WHERE n > 1) AS VARCHAR), '0' FROM "
        "(SELECT user_id, experiment_name, COUNT(DISTINCT variant) AS n FROM assignments GROUP BY 1, 2) x",
    ]
    union = "\n  UNION ALL\n  ".join(parts)
    return (", checks AS (\n  " + union + ")\n, quality AS (SELECT check_name, CASE WHEN observed = expected THEN 'PASS' "
            "ELSE 'FAIL' END AS status, observed, expected, TIMESTAMP '" + AS_OF + "' AS checked_at FROM checks)\n")


_ALL_TABLES = list(ORACLE_NAME.values())

# ============================================================== registrations
register("report_executive_daily", with_tables(["app_events"], _EXEC_DAILY + "SELECT * FROM executive"))(r1)
register("report_retention", with_tables(["app_events", "dim_users"], _RETENTION + "SELECT * FROM retention"))(r2)
register("report_funnel", with_tables(["app_events"], _FUNNEL_REPORT + "SELECT * FROM funnel"))(r3)
register("report_sports_engagement", with_tables(
    ["app_events", "dim_content", "match_events", "dim_matches"], _SPORTS + "SELECT * FROM sports"))(r4)
register("report_marketing", with_tables(["app_events", "dim_users", "campaign_spend"], _MARKETING + "SELECT * FROM marketing"))(r5)
register("report_ab_test", with_tables(["app_events", "assignments"], _AB_REPORT + "SELECT * FROM ab"))(lambda t: r6_(t, conversion_on_test_data()))
register("report_key_moments", with_tables(
    ["app_events", "match_events", "dim_matches"], _MOMENTS_REPORT + f"SELECT {_R7_COLS} FROM moments_report"))(r7)
register("report_quality", with_tables(_ALL_TABLES, _quality_sql() + "SELECT * FROM quality"))(lambda t: r8(t, AS_OF))
register("match_rollup", with_tables(["app_events", "dim_content", "match_events", "dim_matches"], _SPORTS + """
SELECT match_label, MAX(unique_viewers) AS unique_viewers, CAST(SUM(views) AS BIGINT) AS views,
  CAST(SUM(subscriptions) AS BIGINT) AS subscriptions, MAX(xg) AS xg
FROM sports GROUP BY match_label"""))(r9)
register("summary_kpis", with_tables(["app_events", "assignments"], _EXEC_DAILY + _AB_REPORT.replace("\n, outcomes", ",\noutcomes", 1) + """
SELECT (SELECT MAX(dau) FROM executive) AS peak_dau, (SELECT MAX(mau) FROM executive) AS mau,
  (SELECT ROUND(SUM(revenue_usd), 2) FROM executive) AS total_revenue_usd,
  (SELECT CAST(SUM(active_viewers) AS BIGINT) FROM executive) AS active_viewers,
  (SELECT ROUND(relative_lift, 4) FROM ab WHERE variant = 'treatment') AS ab_relative_lift,
  (SELECT ROUND(ci_95_lower, 4) FROM ab WHERE variant = 'treatment') AS ab_ci_lower,
  (SELECT ROUND(ci_95_upper, 4) FROM ab WHERE variant = 'treatment') AS ab_ci_upper"""))(lambda t: r10(t, conversion_on_test_data()))
register("top_match", with_tables(["app_events", "dim_content", "match_events", "dim_matches"], _SPORTS + """
SELECT match_label, MAX(unique_viewers) AS unique_viewers, CAST(SUM(views) AS BIGINT) AS views,
  CAST(SUM(subscriptions) AS BIGINT) AS subscriptions, MAX(xg) AS xg
FROM sports GROUP BY match_label ORDER BY unique_viewers DESC, match_label LIMIT 1"""))(r11_top_match)
register("best_channel", with_tables(["app_events", "dim_users", "campaign_spend"], _MARKETING + """
SELECT * FROM marketing ORDER BY roas_30d DESC NULLS LAST, channel LIMIT 1"""))(r11_best_channel)
register("top_moment", with_tables(["app_events", "match_events", "dim_matches"], _MOMENTS_REPORT + f"""
SELECT {_R7_COLS} FROM moments_report WHERE shot_outcome = 'Goal'
ORDER BY app_events_plus_minus_5m DESC, match_id, event_id LIMIT 1"""))(r11_top_moment)
register("source_counts", with_tables(["app_events", "match_events", "dim_users", "dim_matches"], """
SELECT (SELECT COUNT(*) FROM app_events) AS app_events, (SELECT COUNT(*) FROM match_events) AS match_events,
  (SELECT COUNT(*) FROM dim_users) AS users, (SELECT COUNT(*) FROM dim_matches) AS matches"""))(r12)
register("funnel_by_platform", with_tables(["app_events"], _FUNNEL_REPORT + """,
sums AS (
  SELECT CAST(COALESCE(SUM(notification_users), 0) AS BIGINT) AS a, CAST(COALESCE(SUM(match_center_users), 0) AS BIGINT) AS b,
    CAST(COALESCE(SUM(highlight_users), 0) AS BIGINT) AS c, CAST(COALESCE(SUM(subscription_users), 0) AS BIGINT) AS d
  FROM funnel WHERE experiment_variant = 'treatment')
SELECT 'Notification' AS step, a AS users, """ + r6(sdiv("a", "a")) + """ AS share_of_first FROM sums
UNION ALL SELECT 'Match center', b, """ + r6(sdiv("b", "a")) + """ FROM sums
UNION ALL SELECT 'Highlight', c, """ + r6(sdiv("c", "a")) + """ FROM sums
UNION ALL SELECT 'Subscription', d, """ + r6(sdiv("d", "a")) + """ FROM sums"""))(d1)
_W = {d: sdiv(f"SUM(retention_d{d} * cohort_size)", "SUM(cohort_size)") for d in (1, 7, 30)}
register("retention_overall", with_tables(["app_events", "dim_users"], _RETENTION + f"""
SELECT 1 AS day, {r6(_W[1])} AS retention FROM retention
UNION ALL SELECT 7, {r6(_W[7])} FROM retention
UNION ALL SELECT 30, {r6(_W[30])} FROM retention"""))(d2)
register("retention_by_channel", with_tables(["app_events", "dim_users"], _RETENTION + f"""
SELECT acquisition_channel, {r6(_W[30])} AS retention_d30 FROM retention GROUP BY acquisition_channel"""))(d3)
register("marketing_decision", with_tables(["app_events", "dim_users", "campaign_spend"], _MARKETING + """
SELECT channel, spend_usd, cac_usd, ltv_30d_usd, roas_30d, CASE WHEN roas_30d >= 1 THEN 'Scale' ELSE 'Rework' END AS decision
FROM marketing"""))(d4)
register("metric_selector", with_tables(["app_events"], _EXEC_DAILY + """
SELECT event_date, 'DAU' AS metric, CAST(dau AS DOUBLE) AS value FROM executive
UNION ALL SELECT event_date, 'Active Viewers', CAST(active_viewers AS DOUBLE) FROM executive
UNION ALL SELECT event_date, 'Revenue', revenue_usd FROM executive
UNION ALL SELECT event_date, 'ARPU', arpu_usd FROM executive"""))(d5)
register("target_blend", with_tables(["app_events", "dim_users", "campaign_spend"], _MARKETING + """,
targets AS (SELECT * FROM (VALUES ('paid_search', 77040.0, 14.0, 1.10), ('social', 57780.0, 9.0, 1.20),
  ('partner', 33170.0, 15.0, 1.00)) v(channel, target_spend_usd, target_cac_usd, target_roas_30d))
SELECT m.channel, m.spend_usd, CAST(t.target_spend_usd AS DOUBLE) AS target_spend_usd,
  """ + r6(sdiv("m.spend_usd", "t.target_spend_usd")) + """ AS spend_to_target,
  m.cac_usd, CAST(t.target_cac_usd AS DOUBLE) AS target_cac_usd, m.cac_usd > t.target_cac_usd AS cac_above_target,
  m.roas_30d, CAST(t.target_roas_30d AS DOUBLE) AS target_roas_30d, m.roas_30d < 1 AS roas_below_one
FROM marketing m LEFT JOIN targets t ON m.channel = t.channel"""))(d6)
register("experiment_decision")(lambda t: d7(t, conversion_on_test_data()))
register("shot_map", with_tables(["match_events", "dim_players"], """
SELECT e.match_id, e.event_id, e.x, e.y, e.shot_outcome, e.shot_xg, p.player_name
FROM match_events e LEFT JOIN dim_players p ON e.player_id = p.player_id WHERE e.event_type = 'Shot'"""))(d8)
register("churn_by_segment", with_tables(["app_events", "dim_users"], _COHORT + """
SELECT platform, acquisition_channel, ROUND(1 - """ + sdiv("SUM(retained_d30)", "SUM(cohort_size)") + """, 6) AS churn_d30
FROM aggregated GROUP BY GROUPING SETS ((platform), (acquisition_channel))"""))(d9)
register("quality_scorecard", with_tables(_ALL_TABLES, _USER_DAYS + _MART_CHECKS + _quality_sql() + """,
allc AS (
  SELECT check_name, status, TRY_CAST(observed AS BIGINT) AS observed, TRUE AS suite FROM quality
  UNION ALL SELECT check_name, status, observed, FALSE FROM mart_checks),
tagged AS (
  SELECT 'quality_checks' AS check_group, * FROM allc WHERE suite
  UNION ALL SELECT 'duplicate_keys', * FROM allc
    WHERE check_name LIKE '%.primary_key_unique' OR check_name = 'fact_app_events.duplicate_event_id'
  UNION ALL SELECT 'variant_crossover', * FROM allc
    WHERE check_name IN ('experiment.no_crossover', 'experiment.variant_crossover')
  UNION ALL SELECT 'unknown_users', * FROM allc WHERE check_name IN ('app_events.user_fk', 'app_events.unknown_user')
  UNION ALL SELECT 'fk_gaps', * FROM allc WHERE ends_with(check_name, '_fk') OR check_name = 'app_events.unknown_user'
  UNION ALL SELECT 'invalid_xg', * FROM allc WHERE check_name IN ('match_events.xg_range', 'fact_match_events.invalid_xg')
  UNION ALL SELECT 'reconciliation', * FROM allc WHERE check_name = 'product_daily.revenue_reconciliation')
SELECT check_group, COUNT(*) FILTER (WHERE status = 'PASS') AS passed, COUNT(*) AS total,
  CAST(COALESCE(SUM(GREATEST(observed, 0)), 0) AS BIGINT) AS observed
FROM tagged GROUP BY check_group
UNION ALL
SELECT 'freshness', CAST(CASE WHEN date_diff('day', MAX(event_date), DATE '""" + AS_OF[:10] + """') <= 2 THEN 1 ELSE 0 END AS BIGINT),
  CAST(1 AS BIGINT), CAST(date_diff('day', MAX(event_date), DATE '""" + AS_OF[:10] + """') AS BIGINT)
FROM app_events"""))(d10)
register("engagement_drill", with_tables(["app_events", "dim_content", "dim_matches"], """
SELECT m.competition_name, CAST(e.match_id AS VARCHAR) AS match_id, c.content_type,
  CAST(GROUPING(m.competition_name, e.match_id, c.content_type) AS INTEGER) AS level,
  COUNT(*) AS views, COUNT(DISTINCT e.user_id) AS unique_viewers,
  COUNT(*) FILTER (WHERE e.event_name = 'subscription_start') AS subscriptions
FROM app_events e LEFT JOIN dim_content c ON e.content_id = c.content_id LEFT JOIN dim_matches m ON e.match_id = m.match_id
GROUP BY ROLLUP (m.competition_name, e.match_id, c.content_type)"""))(d11)
register("executive_scorecards", with_tables(["app_events"], _EXEC_DAILY + """
SELECT ROUND(AVG(dau), 6) AS dau, MAX(mau) AS mau, ROUND(AVG(stickiness), 6) AS stickiness,
  """ + r6(sdiv("SUM(subscriptions)", "SUM(dau)")) + """ AS conversion,
  """ + r6(sdiv("SUM(revenue_usd)", "SUM(dau)")) + """ AS arpu_usd, CAST(SUM(active_viewers) AS BIGINT) AS active_viewers
FROM executive"""))(d12)
register("date_dimension", with_tables(["dim_date"], "SELECT * FROM dim_date"))(g1)
register("experiment_assignment")(g2)
register("session_anchor_audit", with_tables(["app_events", "match_events"], """
, starts AS (SELECT session_id, MIN(event_ts) AS s FROM app_events GROUP BY session_id),
pairs AS (SELECT DISTINCT session_id, match_id FROM app_events),
near AS (
  SELECT p.session_id, p.match_id, st.s, a.event_ts AS ats, a.event_id AS aid,
    abs(epoch_us(a.event_ts) - epoch_us(st.s)) AS gap
  FROM pairs p JOIN starts st ON p.session_id = st.session_id
  JOIN match_events a ON a.match_id = p.match_id
    AND a.event_ts BETWEEN st.s - INTERVAL 10 MINUTE AND st.s + INTERVAL 10 MINUTE)
SELECT session_id, match_id, s AS session_started_at, first(ats ORDER BY gap, ats, aid) AS nearest_anchor_ts,
  first(gap ORDER BY gap, ats, aid) / 1e6 AS anchor_gap_seconds, COUNT(*) AS anchors_within
FROM near GROUP BY session_id, match_id, s"""))(g3)
register("event_conversion_rate", with_tables(["app_events"], """
SELECT experiment_variant, COUNT(*) AS events,
  ROUND(AVG(CAST(event_name = 'subscription_start' AS INTEGER)), 6) AS event_conversion_rate
FROM app_events GROUP BY experiment_variant"""))(g4)
register("campaign_key_coverage", with_tables(["app_events", "campaign_spend"], """
, keys AS (SELECT DISTINCT campaign_id AS sk FROM campaign_spend)
SELECT COUNT(*) FILTER (WHERE e.campaign_id IS NOT NULL) AS paid_events,
  COUNT(*) FILTER (WHERE e.campaign_id IS NOT NULL AND k.sk IS NOT NULL) AS matched_spend_rows,
  COUNT(*) FILTER (WHERE e.campaign_id IS DISTINCT FROM
    CASE WHEN e.acquisition_channel IN ('paid_search', 'social', 'partner')
      THEN e.acquisition_channel || '_' || strftime(e.event_date, '%Y%m%d') END) AS key_mismatches
FROM app_events e LEFT JOIN keys k ON e.campaign_id = k.sk"""))(g5)
register("mart_property_checks", with_tables(["app_events"], _USER_DAYS + _FUNNEL_MART + """,
props AS (
  SELECT 'app_events.revenue_only_on_subscriptions' AS check_name,
    COUNT(*) FILTER (WHERE revenue_usd <> 0 AND event_name NOT IN ('subscription_start', 'subscription_cancel')) AS o
  FROM app_events
  UNION ALL SELECT 'product_daily.mau_at_least_dau', COUNT(*) FILTER (WHERE mau < dau) FROM product_daily
  UNION ALL SELECT 'funnel.never_increases', COUNT(*) FILTER (WHERE match_center_users > notification_users
    OR highlight_users > match_center_users OR subscription_users > highlight_users) FROM funnel_mart)
SELECT check_name, CASE WHEN o = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(o AS BIGINT) AS observed,
  CAST(0 AS BIGINT) AS expected FROM props"""))(q_props)


# ============================================================== top-k charts
def key_moments_top12(t):
    """The 12 moments with the most app events (ties: match, event id)."""
    return r7(t, keep_id=True).orderBy(F.desc("app_events_plus_minus_5m"), "match_id", "event_id").limit(12).drop("event_id")


def match_rank_top5(t):
    return r9(t).limit(5)


register("key_moments_top12", with_tables(["app_events", "match_events", "dim_matches"], _MOMENTS_REPORT + f"""
SELECT {_R7_COLS} FROM moments_report ORDER BY app_events_plus_minus_5m DESC, match_id, event_id LIMIT 12"""))(key_moments_top12)
register("match_rank_top5", with_tables(["app_events", "dim_content", "match_events", "dim_matches"], _SPORTS + """
SELECT match_label, MAX(unique_viewers) AS unique_viewers, CAST(SUM(views) AS BIGINT) AS views,
  CAST(SUM(subscriptions) AS BIGINT) AS subscriptions, MAX(xg) AS xg
FROM sports GROUP BY match_label ORDER BY unique_viewers DESC, match_label LIMIT 5"""))(match_rank_top5)


# ============================================================== aggregates around moments
HALF_DAY = 720   # minutes before and after a moment


def moment_revenue_extremes(t):
    return football.moment_revenue_extremes(t["fact_match_events"], t["fact_app_events"], HALF_DAY)


register("moment_revenue_extremes", with_tables(["app_events", "match_events"], f"""
SELECT p.event_id, p.match_id, p.event_ts, p.event_type, {r6('around.least')} AS least_payment_usd, {r6('around.greatest')} AS greatest_payment_usd,
  {r6('around.revenue')} AS revenue_usd, around.opening AS first_event, around.closing AS last_event
FROM match_events p, LATERAL (
  SELECT MIN(a.revenue_usd) FILTER (WHERE a.revenue_usd <> 0) AS least, MAX(a.revenue_usd) FILTER (WHERE a.revenue_usd <> 0) AS greatest,
    SUM(a.revenue_usd) AS revenue, (array_agg(a.event_name ORDER BY a.event_ts, a.event_id))[1] AS opening,
    (array_agg(a.event_name ORDER BY a.event_ts DESC, a.event_id DESC))[1] AS closing
  FROM app_events a WHERE a.match_id = p.match_id AND abs(epoch_us(a.event_ts) - epoch_us(p.event_ts)) <= {HALF_DAY * 60_000_000}) around
WHERE p.period < 5 AND (p.event_type IN ('Substitution', 'Bad Behaviour') OR (p.event_type = 'Shot' AND p.shot_outcome = 'Goal'))"""))(moment_revenue_extremes)
