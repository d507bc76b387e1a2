"""Daily activity, trailing distinct users, cohort retention and ordered funnels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fanpulse.functions.joins import left_join_spread
from fanpulse.functions.scalar import count_if, min_if, safe_divide
from fanpulse.schemas import FUNNEL_ENTRY, FUNNEL_STEPS, VIEW_EVENTS


# --------------------------------------------------------------------------- trailing distinct
def trailing_distinct(
    activity: DataFrame,
    date_col: str = "event_date",
    key: str = "user_id",
    days: int = 30,
    out_date: str = "metric_date",
    out_col: str = "mau",
    method: str = "ranges",
) -> DataFrame:
    """Distinct keys active in the trailing ``days`` days (today and days-1 before)
    for every date that itself has activity.

    A theta join ``d - days < d' <= d`` plans as a nested-loop join; two exact
    linear plans are offered instead:

    * ``"ranges"`` (default): a key active on day ``a`` is counted on metric
      dates ``[a, a + days - 1]``. Per key, the coverage ranges of its active
      days are merged (lag over the key's distinct days - at most one row per
      calendar day, whatever the key's event volume), each merged range adds
      +1 at its start and -1 after its end, and a running sum over the
      calendar gives the distinct count. Work is O(distinct key-days), the
      per-date rows are bounded by the calendar span.
    * ``"explode"``: fan each distinct (key, day) out to the ``days`` metric
      dates it counts for and distinct-count per date (``days`` x key-days).
    """
    both = activity.select(F.col(date_col).alias("_d"), F.col(key).alias("_k")).distinct()
    active_dates = both.select(F.col("_d").alias(out_date)).distinct()
    user_days = both.where(F.col("_k").isNotNull())  # a date keeps its row, a NULL key is nobody
    if method == "explode":
        fanned = user_days.select(
            "_k", F.explode(F.sequence(F.col("_d"), F.date_add(F.col("_d"), days - 1))).alias(out_date)
        )
        return active_dates.join(fanned, out_date, "left").groupBy(out_date).agg(F.count_distinct("_k").alias(out_col))
    if method != "ranges":
        raise ValueError(f"unknown method {method!r}")
    edges = _coverage_edges(user_days, days)
    # every active date gets a row (delta 0) so the running sum is evaluated there
    marks = active_dates.select(F.col(out_date).alias("_day"), F.lit(0).alias("_delta"))
    deltas = edges.unionByName(marks).groupBy("_day").agg(F.sum("_delta").alias("_delta"))
    # one row per calendar date touched: the running sum is a small ordered scan
    calendar = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    counts = deltas.select(F.col("_day").alias(out_date), F.sum("_delta").over(calendar).cast("long").alias(out_col))
    return counts.join(active_dates, out_date, "left_semi")


def _coverage_edges(user_days: DataFrame, days: int) -> DataFrame:
    """``user_days``: distinct _d, _k. _day, _delta: +1 where a key's merged coverage begins, -1 after it ends."""
    by_key = Window.partitionBy("_k").orderBy("_d")
    prev = F.lag("_d").over(by_key)
    starts = user_days.withColumn("_new", F.when(prev.isNull() | (F.datediff("_d", prev) >= days), 1).otherwise(0))
    ranged = starts.withColumn("_r", F.sum("_new").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    spans = ranged.groupBy("_k", "_r").agg(F.min("_d").alias("_lo"), F.max("_d").alias("_hi"))
    return spans.select(F.explode(F.array(
        F.struct(F.col("_lo").alias("_day"), F.lit(1).alias("_delta")),
        F.struct(F.date_add("_hi", days).alias("_day"), F.lit(-1).alias("_delta")),
    )).alias("_e")).select("_e._day", "_e._delta")


def with_trailing_distinct(
    daily: DataFrame, day_col: str, activity: DataFrame, date_col: str = "event_date", key: str = "user_id",
    days: int = 30, out_col: str = "mau",
) -> DataFrame:
    """``daily`` (one row per date) with the distinct keys of the trailing ``days`` days of ``activity``.

    The daily rows are marks on the calendar of the running sum and carry their columns along: no join back, and
    ``activity`` is read once, for two columns."""
    pairs = activity.select(F.col(date_col).alias("_d"), F.col(key).alias("_k")).where("_k is not null").distinct()
    edges = _coverage_edges(pairs, days).groupBy("_day").agg(F.sum("_delta").alias("_delta"))
    row = F.struct(*daily.columns)
    marks = daily.select(F.col(day_col).alias("_day"), F.lit(0).cast("long").alias("_delta"), row.alias("_row"))
    both = marks.unionByName(edges, allowMissingColumns=True)
    calendar = Window.orderBy("_day").rangeBetween(Window.unboundedPreceding, 0)  # rows bounded by the date span
    out = both.select("_row", F.sum("_delta").over(calendar).alias(out_col)).where("_row is not null")
    return out.select("_row.*", out_col)


# --------------------------------------------------------------------------- product daily (M2)
def user_days(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date", "user_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("session_id").alias("sessions"),
        count_if(F.col("event_name") == "subscription_start").alias("subscriptions"),
        F.sum("revenue_usd").alias("net_revenue_usd"),
    )


def product_daily(events: DataFrame, days: int = 30) -> DataFrame:
    """Daily DAU / trailing MAU / sessions / subscriptions / revenue (SQL definitions)."""
    ud = user_days(events)
    daily = ud.groupBy(F.col("event_date").alias("metric_date")).agg(
        F.count("user_id").alias("dau"),
        F.sum("sessions").alias("sessions"),
        F.sum("event_count").alias("events"),
        F.sum("subscriptions").alias("subscriptions"),
        F.sum("net_revenue_usd").alias("revenue_usd"),
    )
    j = with_trailing_distinct(daily, "metric_date", events, days=days)
    return j.select(
        "metric_date", "dau", "mau", "sessions", "events", "subscriptions",
        F.col("revenue_usd"),
        safe_divide("dau", "mau").alias("dau_mau_stickiness"),
        safe_divide("events", "dau").alias("events_per_active_user"),
        safe_divide("subscriptions", "dau").alias("daily_subscription_conversion"),
        safe_divide("revenue_usd", "dau").alias("arpu_usd"),
    )


def executive_daily(events: DataFrame, days: int = 30) -> DataFrame:
    """Report form: sessions = distinct session ids of the day; adds cancellations
    and active viewers (distinct users with a view event, 0 when none).

    Plan: one aggregate per (day, user) - counts, revenue and a viewer flag -
    gives DAU, events, subscriptions, cancellations, revenue and active viewers
    by a second, small aggregate, and feeds the trailing MAU; sessions come
    from a narrow (day, session) distinct. No Expand of the event rows for the
    three distinct counts.
    """
    name = F.col("event_name")
    ud = events.groupBy("event_date", "user_id").agg(
        F.count("event_id").alias("_events"),
        count_if(name == "subscription_start").alias("_subs"),
        count_if(name == "subscription_cancel").alias("_cancels"),
        F.sum("revenue_usd").alias("_rev"),
        F.bool_or(name.isin(*VIEW_EVENTS)).alias("_viewer"),
    )
    has_user = F.col("user_id").isNotNull()
    daily = ud.groupBy("event_date").agg(
        F.count("user_id").alias("dau"),
        F.sum("_events").alias("events"),
        F.sum("_subs").alias("subscriptions"),
        F.sum("_cancels").alias("cancellations"),
        F.sum("_rev").alias("revenue_usd"),
        count_if(has_user & F.col("_viewer")).alias("active_viewers"),
    )
    sessions = events.select("event_date", "session_id").distinct().groupBy("event_date").agg(
        F.count("session_id").alias("sessions"))
    j = with_trailing_distinct(daily.join(sessions, "event_date", "inner"), "event_date", events, days=days)
    return j.select(
        "event_date", "dau", "sessions", "events", "subscriptions", "cancellations",
        F.col("revenue_usd"), "active_viewers", "mau",
        safe_divide("dau", "mau").alias("stickiness"),
        safe_divide("revenue_usd", "dau").alias("arpu_usd"),
        safe_divide("subscriptions", "dau").alias("subscription_conversion"),
    )


# --------------------------------------------------------------------------- retention (M3, R2)
def cohort_retention(
    users: DataFrame,
    events: DataFrame,
    keys: Sequence[str] = ("acquisition_channel", "platform"),
    days: Sequence[int] = (1, 7, 30),
    by_cohort_date: bool = True,
    user: str = "user_id",
    signup: str = "signup_date",
    activity_date: str = "event_date",
) -> DataFrame:
    """Exact-day retention per cohort. Users with no activity stay in the cohort.

    Plan: distinct (user, day) activity is joined to the users' signup dates
    and reduced to one flag row per (user, signup) - so a user's fan-out is
    bounded by their active days - then the cohort rows left-join these
    flags and are counted. No distinct-count Expand over the events.
    """
    keys = list(keys)
    cohorts = users.select(F.col(user).alias("_u"), F.col(signup).alias("cohort_date"), *keys).distinct()
    activity = events.select(F.col(user).alias("_u"), F.col(activity_date).alias("_ad")).distinct()
    signups = cohorts.select("_u", "cohort_date").distinct()
    hits = activity.join(signups, "_u").withColumn("_dn", F.datediff("_ad", "cohort_date"))
    hits = hits.where(F.col("_dn").isin(*days))
    flags = hits.groupBy("_u", "cohort_date").agg(
        *[F.max((F.col("_dn") == d).cast("int")).alias(f"_f{d}") for d in days]
    )
    rows = cohorts.join(flags, ["_u", "cohort_date"], "left")
    group = (["cohort_date"] if by_cohort_date else []) + keys
    per_user = rows.groupBy(*group, "_u").agg(*[F.max(f"_f{d}").alias(f"_f{d}") for d in days])
    agg = per_user.groupBy(*group).agg(
        F.count("_u").alias("cohort_size"),
        *[F.coalesce(F.sum(f"_f{d}"), F.lit(0)).cast("long").alias(f"retained_d{d}") for d in days],
    )
    rates = {f"retention_d{d}": safe_divide(f"retained_d{d}", "cohort_size") for d in days}
    last = days[-1]
    churn = (F.lit(1.0) - safe_divide(f"retained_d{last}", "cohort_size")).alias(f"churn_d{last}")
    if by_cohort_date:
        return agg.select(
            *group, "cohort_size", *[f"retained_d{d}" for d in days],
            *[rates[f"retention_d{d}"].alias(f"retention_d{d}") for d in days], churn,
        )
    interleaved = []
    for d in days:
        interleaved += [F.col(f"retained_d{d}"), rates[f"retention_d{d}"].alias(f"retention_d{d}")]
    return agg.select(*group, "cohort_size", *interleaved, churn)


# --------------------------------------------------------------------------- funnel (M4, R3)
def _step_col(step: str) -> str:
    return f"{step}_at"


def ordered_funnel(
    events: DataFrame,
    journey_keys: Sequence[str] = ("user_id", "match_id", "platform", "experiment_variant"),
    steps: Sequence[str] = FUNNEL_STEPS,
    entry_events: Sequence[str] = FUNNEL_ENTRY,
    ts: str = "event_ts",
    name: str = "event_name",
    drop_null_keys: bool = False,
) -> DataFrame:
    """One row per journey: first event time, first time of each step and the
    reached flags. A step counts only if every earlier step was reached and
    its first time is strictly later than the previous step's first time
    (first overall occurrence, not first after the previous step)."""
    keys = list(journey_keys)
    e = events.where(F.col(name).isin(*entry_events, *steps))
    if drop_null_keys:
        for k in keys:
            e = e.where(F.col(k).isNotNull())
    j = e.groupBy(*keys).agg(
        F.min(ts).alias("first_event_at"),
        *[min_if(F.col(name) == s, ts).alias(_step_col(s)) for s in steps],
    )
    reached = []
    cond = F.col(_step_col(steps[0])).isNotNull()
    reached.append(cond.alias(f"reached_{steps[0]}"))
    for prev, cur in zip(steps, steps[1:]):
        cond = cond & (F.col(_step_col(cur)) > F.col(_step_col(prev)))
        reached.append(cond.alias(f"reached_{cur}"))
    return j.select("*", *reached)


_FUNNEL_OUT = ("notification_users", "match_center_users", "highlight_users", "subscription_users")
_FUNNEL_RATES = ("notification_to_match", "match_to_highlight", "highlight_to_subscription")


def funnel_summary(journeys: DataFrame, group: Sequence[str], total_name: str, steps=FUNNEL_STEPS) -> DataFrame:
    g = journeys.groupBy(*group).agg(
        F.count(F.lit(1)).alias(total_name),
        *[count_if(F.col(f"reached_{s}")).alias(o) for s, o in zip(steps, _FUNNEL_OUT)],
    )
    rates = [
        safe_divide(b, a).alias(r) for (a, b), r in zip(zip(_FUNNEL_OUT, _FUNNEL_OUT[1:]), _FUNNEL_RATES)
    ]
    return g.select(
        *group, total_name, *_FUNNEL_OUT, *rates,
        safe_divide(_FUNNEL_OUT[-1], total_name).alias("end_to_end_conversion"),
    )


def funnel_mart(events: DataFrame) -> DataFrame:
    j = ordered_funnel(events).withColumn("funnel_date", F.to_date("first_event_at"))
    return funnel_summary(j, ["funnel_date", "platform", "experiment_variant"], "user_match_journeys")


def funnel_report(events: DataFrame) -> DataFrame:
    j = ordered_funnel(events, entry_events=(), drop_null_keys=True)
    return funnel_summary(j, ["platform", "experiment_variant"], "journeys")


def engagement_drill(events: DataFrame, content: DataFrame, matches: DataFrame) -> DataFrame:
    """Views, distinct viewers and subscriptions by (competition, match, content type) and every level above, down to the total.

    ``level`` is the grouping id of a rollup (0, 1, 3, 7). Viewers are exact sets: a bitmap per 32,768 user numbers, made once
    from the events, then or-ed into every level above. The events are shuffled once, as partial bitmaps; no event or user row
    is copied per level. A bitmap has 4 KB whatever the number of users in it, so hot matches and hot users cost no more. User ids must be whole numbers; dense ones make full bitmaps.
    """
    if dict(events.dtypes)["user_id"] not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError("user ids must be whole numbers: number the users first")
    user = F.col("user_id").cast("long")
    rows = events.groupBy("match_id", "content_id", F.bitmap_bucket_number(user).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_views"), count_if(F.col("event_name") == "subscription_start").alias("_subs"),
        F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("_users"))
    rows = left_join_spread(rows, content.select("content_id", "content_type"), "content_id", ["match_id", "_bucket"])
    rows = rows.join(matches.select("match_id", "competition_name"), "match_id", "left")
    keys, types = ["competition_name", "match_id", "content_type"], dict(rows.dtypes)
    levels = F.array(*[
        F.struct(F.lit(level).alias("level"), *[(F.col(k) if i < depth else F.lit(None).cast(types[k])).alias(k) for i, k in enumerate(keys)])
        for depth, level in ((3, 0), (2, 1), (1, 3), (0, 7))])
    rows = rows.select(F.explode(levels).alias("_at"), "_bucket", "_views", "_subs", "_users").select("_at.*", "_bucket", "_views", "_subs", "_users")
    rows = rows.groupBy("level", *keys, "_bucket").agg(F.sum("_views").alias("_views"), F.sum("_subs").alias("_subs"), F.bitmap_or_agg("_users").alias("_users"))
    return rows.groupBy("level", *keys).agg(
        F.sum("_views").alias("views"), F.sum(F.bitmap_count("_users")).alias("unique_viewers"), F.sum("_subs").alias("subscriptions"))
