"""Experiment assignment and two-proportion analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanpulse.functions.joins import unique_by
from fanpulse.functions.scalar import count_if, safe_divide

Z_95 = 1.96  # two-sided 95% critical value


def default_conversion() -> Column:
    return F.col("event_name") == "subscription_start"


def assign_variant(
    users: DataFrame,
    experiment: str,
    variants: Sequence[str] = ("control", "treatment"),
    weights: Sequence[float] = (0.5, 0.5),
    buckets: int = 10_000,
    assigned_at: str = "signup_date",
) -> DataFrame:
    """Deterministic assignment: 32 bits of md5 of "experiment:user" -> bucket -> variant.
    A user always gets the same variant for an experiment (no crossover), and
    every executor computes it locally without a lookup table."""
    digest = F.md5(F.concat_ws(":", F.lit(experiment), F.col("user_id").cast("string")))
    bucket = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets))
    total = float(sum(weights))
    expr, acc = None, 0.0
    for v, w in zip(variants, weights):
        acc += w / total
        cond = bucket < F.lit(int(round(acc * buckets)))
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    expr = expr.otherwise(variants[-1])
    return users.select(
        "user_id", F.lit(experiment).alias("experiment_name"), expr.alias("variant"),
        F.col(assigned_at).cast("timestamp_ntz").alias("assigned_at"),
    )


def _per_user(events: DataFrame, conversion: Column) -> DataFrame:
    """Pre-aggregate the events per user (so a heavy user joins as one row)."""
    name = F.col("event_name")
    return events.groupBy("user_id").agg(
        count_if(name == "match_center_view").alias("_mc"),
        count_if(name == "highlight_view").alias("_hl"),
        F.bool_or(conversion).alias("_conv"),
        F.sum(F.coalesce("revenue_usd", F.lit(0.0))).alias("_rev"),
    )


def user_outcomes(assignments: DataFrame, events: DataFrame, experiment: str | None, conversion: Column | None = None) -> DataFrame:
    """One row per (user, variant): views, conversion flag (NULL without
    events), revenue. Equivalent to assignments LEFT JOIN events, grouped."""
    a = assignments if experiment is None else assignments.where(F.col("experiment_name") == experiment)
    per = _per_user(events, conversion if conversion is not None else default_conversion())
    j = a.select("user_id", "variant").join(per, "user_id", "left")
    return j.groupBy("user_id", "variant").agg(
        F.sum(F.coalesce("_mc", F.lit(0))).alias("match_center_views"),
        F.sum(F.coalesce("_hl", F.lit(0))).alias("highlight_views"),
        F.bool_or("_conv").alias("converted"),
        F.sum(F.coalesce("_rev", F.lit(0.0))).alias("net_revenue_usd"),
        F.max(F.col("_mc").isNotNull()).alias("has_events"),
    )


def variant_metrics(outcomes: DataFrame, denominator: str = "sql") -> DataFrame:
    """Per-variant metrics. ``denominator='sql'``: users without events have a
    NULL conversion flag and leave the rate's denominator (the mart's SQL);
    ``'assigned'``: the rate is over all assigned users (the dictionary's
    definition), i.e. no events counts as not converted."""
    if denominator == "assigned":
        outcomes = outcomes.withColumn("converted", F.coalesce("converted", F.lit(False)))
    elif denominator != "sql":
        raise ValueError(f"unknown denominator {denominator!r}")
    return outcomes.groupBy("variant").agg(
        F.count(F.lit(1)).alias("users"),
        count_if(F.col("converted")).alias("converted_users"),
        F.avg(F.col("converted").cast("int")).alias("conversion_rate"),
        F.avg("match_center_views").alias("avg_match_center_views"),
        F.avg("highlight_views").alias("avg_highlight_views"),
        F.avg("net_revenue_usd").alias("arpu_usd"),
    )


def two_proportion_test(metrics: DataFrame, control: str = "control", treatment: str = "treatment") -> DataFrame:
    """Pivot the per-variant rows to one row and add pooled/unpooled statistics.
    z uses the pooled standard error; the CI uses the unpooled one."""
    v = F.col("variant")
    pick = lambda arm, c: F.max(F.when(v == arm, F.col(c)))
    wide = metrics.agg(
        pick(control, "users").alias("control_users"),
        pick(treatment, "users").alias("treatment_users"),
        pick(control, "converted_users").alias("control_converted"),
        pick(treatment, "converted_users").alias("treatment_converted"),
        pick(control, "conversion_rate").alias("control_rate"),
        pick(treatment, "conversion_rate").alias("treatment_rate"),
        pick(control, "avg_match_center_views").alias("control_match_views"),
        pick(treatment, "avg_match_center_views").alias("treatment_match_views"),
        pick(control, "arpu_usd").alias("control_arpu"),
        pick(treatment, "arpu_usd").alias("treatment_arpu"),
    )
    cr, tr, cu, tu = F.col("control_rate"), F.col("treatment_rate"), F.col("control_users"), F.col("treatment_users")
    s = wide.withColumns({
        "pooled_rate": safe_divide(F.col("control_converted") + F.col("treatment_converted"), cu + tu),
        "absolute_lift": tr - cr,
    })
    p = F.col("pooled_rate")
    s = s.withColumns({
        "pooled_standard_error": F.sqrt(p * (1 - p) * (safe_divide(F.lit(1), cu) + safe_divide(F.lit(1), tu))),
        "lift_standard_error": F.sqrt(safe_divide(cr * (1 - cr), cu) + safe_divide(tr * (1 - tr), tu)),
    })
    lift, z = F.col("absolute_lift"), safe_divide("absolute_lift", "pooled_standard_error")
    s = s.withColumns({
        "relative_lift": safe_divide(lift, cr),
        "z_score": z,
        "ci_95_lower": lift - Z_95 * F.col("lift_standard_error"),
        "ci_95_upper": lift + Z_95 * F.col("lift_standard_error"),
        "significant_at_95pct": F.abs(z) >= Z_95,
    })
    return s


def ab_test_mart(
    assignments: DataFrame, events: DataFrame, experiment: str = "match_center_v2",
    conversion: Column | None = None, denominator: str = "sql",
) -> DataFrame:
    return two_proportion_test(variant_metrics(user_outcomes(assignments, events, experiment, conversion), denominator))


def ab_test_report(assignments: DataFrame, events: DataFrame, conversion: Column | None = None, experiment: str | None = None) -> DataFrame:
    """Report form: two rows by variant; users without events are left out of
    the means (skip-NULL); significance = unpooled CI excludes 0. Fails if a
    user is assigned twice (choose one ``experiment`` where there are several)."""
    a = assignments if experiment is None else assignments.where(F.col("experiment_name") == experiment)
    a = unique_by(a.select("user_id", "variant"), ["user_id"], "assignments")
    o = user_outcomes(a, events, None, conversion)
    nulls = lambda c: F.when(F.col("has_events"), F.col(c))
    m = o.groupBy("variant").agg(
        F.count_distinct("user_id").alias("users"),
        count_if(F.col("converted")).alias("converted_users"),
        F.avg(F.col("converted").cast("int")).alias("conversion_rate"),
        F.avg(nulls("match_center_views")).alias("avg_match_center_views"),
        F.avg(nulls("net_revenue_usd")).alias("arpu_usd"),
    )
    # one row holding both arms and the statistics, then one output row per arm
    # (inline of an array of structs) - no join of the two shapes
    v = F.col("variant")
    arms = ("control", "treatment")
    cols = ("users", "converted_users", "conversion_rate", "avg_match_center_views", "arpu_usd")
    wide = m.agg(*[F.max(F.when(v == a, F.col(c))).alias(f"{a}_{c}") for a in arms for c in cols])
    cr, tr = F.col("control_conversion_rate"), F.col("treatment_conversion_rate")
    se = F.sqrt(safe_divide(cr * (1 - cr), "control_users") + safe_divide(tr * (1 - tr), "treatment_users"))
    lo, hi = tr - cr - Z_95 * se, tr - cr + Z_95 * se
    stats = {
        "absolute_lift": tr - cr, "relative_lift": safe_divide(tr - cr, cr),
        "ci_95_lower": lo, "ci_95_upper": hi,
        "significant_at_95pct": ~((lo <= 0) & (hi >= 0)),
    }
    rows = F.array(*[
        F.struct(
            F.lit(a).alias("variant"), F.col(f"{a}_users").alias("users"),
            F.col(f"{a}_converted_users").alias("converted_users"),
            F.col(f"{a}_conversion_rate").alias("conversion_rate"),
            F.col(f"{a}_avg_match_center_views").alias("avg_match_center_views"),
            F.col(f"{a}_arpu_usd").alias("arpu_usd"),
            *[e.alias(k) for k, e in stats.items()],
        )
        for a in arms
    ])
    present = F.array(*[F.col(f"{a}_users").isNotNull() for a in arms])
    out = wide.select(F.inline(F.filter(F.arrays_zip(rows.alias("r"), present.alias("p")), lambda x: x["p"])))
    return out.select("r.*")


def experiment_decision(mart: DataFrame) -> DataFrame:
    return mart.select(
        "absolute_lift", "relative_lift", "ci_95_lower", "ci_95_upper",
        F.when(F.col("ci_95_lower") > 0, "Significant lift").otherwise("Inconclusive").alias("decision"),
    )


def event_conversion_rate(events: DataFrame, variant: str = "experiment_variant") -> DataFrame:
    """Event-level share of subscription starts per variant."""
    return events.groupBy(variant).agg(
        F.count(F.lit(1)).alias("events"),
        F.avg((F.col("event_name") == "subscription_start").cast("int")).alias("event_conversion_rate"),
    )
