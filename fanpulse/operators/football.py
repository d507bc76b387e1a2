"""Football marts: team-match stats, match engagement, key-moment interval lift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fanpulse.functions.joins import left_join_spread, unique_by
from fanpulse.functions.scalar import add_minutes, bin_of, count_if, safe_divide, whole_minutes
from fanpulse.operators.windows import window_merged
from fanpulse.schemas import KEY_MOMENT_TYPES

MATCH_COLUMNS = (
    "match_date", "kick_off", "competition_id", "competition_name", "season_id", "season_name",
    "home_team_id", "home_team_name", "away_team_id", "away_team_name", "home_score", "away_score",
)


def regular_play(match_events: DataFrame, max_period: int = 4) -> DataFrame:
    """Regular play only (drops the penalty shootout, period 5)."""
    return match_events.where(F.col("period") <= max_period)


# --------------------------------------------------------------------------- M6
def match_teams(matches: DataFrame) -> DataFrame:
    """Home and away side of every match as two rows (array-of-struct unnest)."""
    sides = F.array(
        F.struct(F.col("home_team_id").alias("team_id"), F.col("home_team_name").alias("team_name")),
        F.struct(F.col("away_team_id").alias("team_id"), F.col("away_team_name").alias("team_name")),
    )
    return matches.select("match_id", "match_date", "competition_name", F.inline(sides))


def team_match(matches: DataFrame, match_events: DataFrame, possession_denominator: str = "all") -> DataFrame:
    """Per team and match: shots, goals, xG, passes, completion, tackles, duels,
    pressure and the event-share possession proxy.

    ``possession_denominator='all'`` divides by all regular-play events of the
    match (the mart's definition); ``'labelled'`` only by events carrying a
    possession team.
    """
    ev = regular_play(match_events)
    et = F.col("event_type")
    team_events = ev.groupBy("match_id", "team_id").agg(
        count_if(et == "Shot").alias("shots"),
        count_if((et == "Shot") & (F.col("shot_outcome") == "Goal")).alias("goals"),
        F.sum(F.coalesce("shot_xg", F.lit(0.0))).alias("xg"),
        count_if(et == "Pass").alias("passes"),
        count_if((et == "Pass") & (F.col("pass_outcome") == "Complete")).alias("completed_passes"),
        count_if((et == "Duel") & (F.col("duel_type") == "Tackle")).alias("tackles"),
        count_if(et == "Duel").alias("duels"),
        count_if(F.col("under_pressure")).alias("events_under_pressure"),
    )
    possession = (
        ev.where(F.col("possession_team_id").isNotNull())
        .groupBy("match_id", F.col("possession_team_id").alias("team_id"))
        .agg(F.count(F.lit(1)).alias("possession_event_count"))
    )
    totals_src = ev if possession_denominator == "all" else ev.where(F.col("possession_team_id").isNotNull())
    totals = totals_src.groupBy("match_id").agg(F.count(F.lit(1)).alias("match_event_count"))
    j = (
        match_teams(matches)
        .join(team_events, ["match_id", "team_id"], "left")
        .join(possession, ["match_id", "team_id"], "left")
        .join(totals, "match_id", "left")
    )
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return j.select(
        "match_id", "match_date", "competition_name", "team_id", "team_name",
        z("shots"), z("goals"), F.coalesce("xg", F.lit(0.0)).alias("xg"), z("passes"),
        z("completed_passes"), safe_divide("completed_passes", "passes").alias("pass_completion_rate"),
        z("tackles"), z("duels"), z("events_under_pressure"),
        safe_divide("possession_event_count", "match_event_count").alias("possession_share"),
    )


# --------------------------------------------------------------------------- M5, R4
def _engagement(app_events: DataFrame, content: DataFrame) -> DataFrame:
    """Per (match, content type incl. NULL): views, distinct viewers and
    sessions, subscriptions, revenue. A (match, type, user) pre-aggregate
    carries the counts and the viewer count; sessions come from a narrow
    (match, type, session) distinct - no Expand of the event rows. Events
    without content are spread over the join's tasks."""
    ev = left_join_spread(app_events, content.select("content_id", "content_type"), "content_id", ["user_id", "session_id"])
    keys = ["match_id", "content_type"]
    per_user = ev.groupBy(*keys, "user_id").agg(
        F.count(F.lit(1)).alias("_views"),
        count_if(F.col("event_name") == "subscription_start").alias("_subs"),
        F.sum("revenue_usd").alias("_rev"),
    )
    totals = per_user.groupBy(*keys).agg(
        F.sum("_views").alias("views"),
        F.count("user_id").alias("unique_viewers"),
        F.sum("_subs").alias("subscriptions"),
        F.sum("_rev").alias("net_revenue_usd"),
    )
    sessions = ev.select(*keys, "session_id").distinct().groupBy(*keys).agg(F.count("session_id").alias("sessions"))
    sessions = sessions.select(*[F.col(k).alias(f"_s_{k}") for k in keys], "sessions")
    cond = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]  # the content type may be NULL
    j = totals.join(sessions, cond, "inner")
    return j.select(*keys, "views", "unique_viewers", "sessions", "subscriptions", "net_revenue_usd")


def sports_engagement(app_events: DataFrame, content: DataFrame, match_events: DataFrame, matches: DataFrame) -> DataFrame:
    et = F.col("event_type")
    football = regular_play(match_events).groupBy("match_id").agg(
        count_if(et == "Shot").alias("shots"),
        count_if((et == "Shot") & (F.col("shot_outcome") == "Goal")).alias("goals_in_events"),
        F.sum(F.coalesce("shot_xg", F.lit(0.0))).alias("total_xg"),
        count_if(et == "Pass").alias("passes"),
        count_if(et == "Duel").alias("duels"),
    )
    j = _engagement(app_events, content).join(matches, "match_id").join(football, "match_id")
    return j.select(
        "match_id", "match_date", "competition_name", "season_name", "home_team_name", "away_team_name",
        "home_score", "away_score", "content_type", "shots", "goals_in_events",
        F.col("total_xg"), "passes", "duels", "views", "unique_viewers", "sessions",
        "subscriptions", F.col("net_revenue_usd"),
        safe_divide("subscriptions", "unique_viewers").alias("viewer_conversion_rate"),
    )


def match_label(home: str = "home_team_name", away: str = "away_team_name") -> Column:
    return F.concat(F.col(home), F.lit(" vs "), F.col(away))


def sports_report(app_events: DataFrame, content: DataFrame, match_events: DataFrame, matches: DataFrame) -> DataFrame:
    """Extract form: adds tackles and every match column plus a label. Fails if a content or match id occurs twice."""
    content = unique_by(content.select("content_id", "content_type"), ["content_id"], "content")
    matches = unique_by(matches.select("match_id", *MATCH_COLUMNS), ["match_id"], "matches")
    et = F.col("event_type")
    football = regular_play(match_events).groupBy("match_id").agg(
        count_if(et == "Shot").alias("shots"),
        count_if((et == "Shot") & (F.col("shot_outcome") == "Goal")).alias("goals"),
        F.sum(F.coalesce("shot_xg", F.lit(0.0))).alias("xg"),
        count_if(et == "Pass").alias("passes"),
        count_if(F.col("duel_type") == "Tackle").alias("tackles"),
    )
    j = _engagement(app_events, content).join(football, "match_id").join(matches, "match_id")
    return j.select(
        "match_id", "content_type", "views", "unique_viewers", "sessions", "subscriptions",
        F.col("net_revenue_usd").alias("revenue_usd"), "shots", "goals", F.col("xg"),
        "passes", "tackles", *MATCH_COLUMNS,
        safe_divide("subscriptions", "unique_viewers").alias("viewer_conversion_rate"),
        match_label().alias("match_label"),
    )


# --------------------------------------------------------------------------- linear interval counts (M7, R7, G3)
def window_counts(
    moments: DataFrame,
    events: DataFrame,
    key: str,
    moment_ts: str,
    event_ts: str,
    before_minutes: int,
    after_minutes: int,
    counts: Mapping[str, Column],
    distinct: Mapping[str, str] | None = None,
    half_open: bool = False,
    nearest: str | None = None,
) -> DataFrame:
    """For every moment, the events of its ``key`` with ``moment - before <= event <= moment + after``
    (``< moment + after`` when ``half_open``), counted without pairing moments and events.

    ``counts``: name -> condition, the events for which it is true. ``distinct``: name -> column, its distinct
    values. ``nearest``: name of a column for the time of the nearest event of the key, however far (ties: earlier).

    An event counts for the moments in ``[event - after, event + before]``. So a count at a moment is the number of
    such spans begun by then less those ended before it: running sums on one timeline per key. Of a distinct value,
    overlapping spans are merged first; its events are reduced to the least and greatest time per window-wide bin,
    whose spans always overlap. Running sums are taken per (key, bin) and offset by the sums of earlier bins, so no
    task holds all of a key. Work grows with distinct event times plus moments. Moments keep their rows; a NULL key
    or time counts nothing.
    """
    distinct = distinct or {}
    names = [*counts, *distinct]
    width = (before_minutes + after_minutes) * 60
    begin, end = add_minutes(F.col("_e"), -after_minutes), add_minutes(F.col("_e"), before_minutes)
    known = events.where(F.col(key).isNotNull() & F.col(event_ts).isNotNull())

    def points(rows: DataFrame, first: Column, last: Column, values: Mapping[str, Column], here: Column | None = None) -> DataFrame:
        """Two timeline rows for a span, and one at the event itself where its time is asked for."""
        zero = F.lit(0).cast("long")
        ts_type = rows.schema["_e"].dataType

        def point(t: Column, begins: bool, ends: bool, at: Column | None = None) -> Column:
            sums = [(values[n] if n in values and on else zero).cast("long").alias(f"{side}{i}")
                    for side, on in (("_b", begins), ("_z", ends)) for i, n in enumerate(names)]
            at = F.lit(None).cast(ts_type) if at is None else at
            return F.struct(t.alias("_t"), *sums, at.alias("_at"), F.lit(False).alias("_asked"))

        made = [point(first, True, False), point(last, False, True)]
        made += [point(here, False, False, here)] if here is not None else []
        return rows.select("_k", F.inline(F.array(*made)))

    at_time = known.groupBy(F.col(key).alias("_k"), F.col(event_ts).alias("_e")).agg(
        *[count_if(cond).alias(f"_n{i}") for i, cond in enumerate(counts.values())])
    line = points(at_time, begin, end, {n: F.col(f"_n{i}") for i, n in enumerate(counts)}, F.col("_e") if nearest else None)
    for name, value in distinct.items():
        per_bin = known.where(F.col(value).isNotNull()).groupBy(
            F.col(key).alias("_k"), F.col(value).alias("_v"), bin_of(F.col(event_ts), width).alias("_bin")
        ).agg(F.min(event_ts).alias("_e"), F.max(event_ts).alias("_last"))
        in_order = Window.partitionBy("_k", "_v").orderBy("_bin")
        apart = F.coalesce(F.lag("_last").over(in_order) < add_minutes(F.col("_e"), -(before_minutes + after_minutes)), F.lit(True))
        spans = per_bin.withColumn("_apart", apart).withColumn("_run", F.sum(F.col("_apart").cast("int")).over(in_order)).groupBy(
            "_k", "_v", "_run").agg(F.min("_e").alias("_e"), F.max("_last").alias("_last"))
        line = line.unionByName(points(spans, begin, add_minutes(F.col("_last"), before_minutes), {name: F.lit(1)}))

    sums = [f"{side}{i}" for side in ("_b", "_z") for i in range(len(names))]
    asked = moments.where(F.col(key).isNotNull() & F.col(moment_ts).isNotNull()).select(
        F.col(key).alias("_k"), F.col(moment_ts).alias("_t"), *[F.lit(0).cast("long").alias(c) for c in sums],
        F.lit(None).cast(line.schema["_at"].dataType).alias("_at"), F.lit(True).alias("_asked"))
    line = line.unionByName(asked).groupBy("_k", "_t").agg(
        *[F.sum(c).alias(c) for c in sums], F.max("_at").alias("_at"), F.bool_or("_asked").alias("_asked"))
    line = line.withColumn("_bin", bin_of(F.col("_t"), width))

    # offsets of a bin: sums of the key's earlier bins, and the nearest event times outside it
    earlier = Window.partitionBy("_k").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    # backwards in an order of its own: a frame that reaches to the end of its partition is recomputed for every row
    later = Window.partitionBy("_k").orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    totals = line.groupBy("_k", "_bin").agg(*[F.sum(c).alias(c) for c in sums], F.min("_at").alias("_lo"), F.max("_at").alias("_hi"))
    offsets = totals.select(
        F.col("_k").alias("_ok"), F.col("_bin").alias("_obin"), *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_o{c}") for c in sums],
        *([F.max("_hi").over(earlier).alias("_o_prev"), F.min("_lo").over(later).alias("_o_next")] if nearest else []))
    inside = Window.partitionBy("_k", "_bin").orderBy("_t")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("_k", "_bin").orderBy(F.desc("_t")).rowsBetween(Window.unboundedPreceding, 0)
    running = line.select(
        "_k", "_t", "_bin", "_asked", *[F.col(f"_b{i}").alias(f"_own{i}") for i in range(len(names))], *[F.col(f"_z{i}").alias(f"_zown{i}") for i in range(len(names))],
        *[F.sum(c).over(so_far).alias(c) for c in sums],
        *([F.max("_at").over(so_far).alias("_prev"), F.min("_at").over(back).alias("_next")] if nearest else []))
    found = running.where("_asked").join(offsets, (F.col("_k") == F.col("_ok")) & (F.col("_bin") == F.col("_obin")))
    begun = [F.col(f"_b{i}") + F.col(f"_o_b{i}") - (F.col(f"_own{i}") if half_open else F.lit(0)) for i in range(len(names))]
    ended = [F.col(f"_z{i}") + F.col(f"_o_z{i}") - F.col(f"_zown{i}") for i in range(len(names))]
    out = [(b - z).alias(f"_c{i}") for i, (b, z) in enumerate(zip(begun, ended))]
    if nearest:
        prev, following, us = F.coalesce("_prev", "_o_prev"), F.coalesce("_next", "_o_next"), lambda c: F.unix_micros(c.cast("timestamp"))
        near = F.when(prev.isNull() | (us(following) - us(F.col("_t")) < us(F.col("_t")) - us(prev)), following).otherwise(prev)
        out.append(near.alias("_near"))
    found = found.select(F.col("_k").alias("_fk"), F.col("_t").alias("_ft"), *out)
    j = moments.join(found, (moments[key] == F.col("_fk")) & (moments[moment_ts] == F.col("_ft")), "left")
    return j.select(*[moments[c] for c in moments.columns], *[F.coalesce(f"_c{i}", F.lit(0)).alias(n) for i, n in enumerate(names)],
                    *([F.col("_near").alias(nearest)] if nearest else []))


# --------------------------------------------------------------------------- interval join with any aggregate (J6)
def interval_counts(
    moments: DataFrame,
    events: DataFrame,
    key: str,
    moment_ts: str,
    event_ts: str,
    before_minutes: int,
    after_minutes: int,
    aggs: Sequence[Column],
    half_open: bool = False,
    moment_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Left interval join + aggregate: for every moment, aggregate the events of
    the same ``key`` with ``moment - before <= event <= moment + after``
    (``< moment + after`` when ``half_open``). For aggregates that ``window_counts``
    cannot take as running sums: it pairs moments with the events of their windows.

    Binned equi-join: every event gets the one fixed-width time bin it lies in,
    every moment the (at most two) bins its window overlaps; the join is on
    (key, bin) with the exact bound as residual. A key with few values (match
    id) therefore never forms one giant join group, and AQE can broadcast the
    moment side or split a skewed (key, bin) partition. Moments without events
    are added back by a union (count aggregates ignore their NULL event
    columns), which keeps LEFT JOIN semantics without a second join.
    """
    moment_cols = list(moment_cols or moments.columns)
    width = (before_minutes + after_minutes) * 60
    lo = add_minutes(F.col(moment_ts), -before_minutes)
    hi = add_minutes(F.col(moment_ts), after_minutes)
    m = moments.select(
        *moment_cols, lo.alias("_lo"), hi.alias("_hi"),
        F.explode(F.sequence(bin_of(lo, width), bin_of(hi, width))).alias("_bin"),
    )
    ev_cols = [c for c in events.columns if c != key]
    e = events.select(
        F.col(key).alias("_ekey"), *[F.col(c).alias(f"_e_{c}") for c in ev_cols],
        bin_of(F.col(event_ts), width).alias("_bin"),
    )
    upper_ok = F.col(f"_e_{event_ts}") < F.col("_hi") if half_open else F.col(f"_e_{event_ts}") <= F.col("_hi")
    cond = (
        (m[key] == e["_ekey"]) & (m["_bin"] == e["_bin"])
        & (F.col(f"_e_{event_ts}") >= F.col("_lo")) & upper_ok
    )
    pairs = m.join(e, cond, "inner").select(*moment_cols, *[f"_e_{c}" for c in ev_cols])
    empty = moments.select(*moment_cols, *[F.lit(None).cast(events.schema[c].dataType).alias(f"_e_{c}") for c in ev_cols])
    both = pairs.unionByName(empty)
    return both.groupBy(*moment_cols).agg(*aggs)


def key_moments(match_events: DataFrame, all_shots: bool = False) -> DataFrame:
    et = F.col("event_type")
    shot = (et == "Shot") if all_shots else ((et == "Shot") & (F.col("shot_outcome") == "Goal"))
    return regular_play(match_events).where(et.isin(*KEY_MOMENT_TYPES) | shot)


def match_windows(match_events: DataFrame, pad_before: int = 30, pad_after: int = 15) -> DataFrame:
    return regular_play(match_events).groupBy("match_id").agg(
        add_minutes(F.min("event_ts"), -pad_before).alias("window_start"),
        add_minutes(F.max("event_ts"), pad_after).alias("window_end"),
    )


def baseline_rate(windows: DataFrame, app_events: DataFrame, half_open: bool = False, fractional: bool = False) -> DataFrame:
    """App events of the match inside its window, per 10 minutes of window.

    One window row per match: AQE broadcasts it, so the events are streamed
    without a shuffle and a hot match never meets a single task.
    """
    ev = app_events.select(F.col("match_id").alias("_m"), F.col("event_ts").alias("_ts"), F.col("event_id").alias("_id"))
    upper = F.col("_ts") < F.col("window_end") if half_open else F.col("_ts") <= F.col("window_end")
    cond = (F.col("match_id") == F.col("_m")) & (F.col("_ts") >= F.col("window_start")) & upper
    # inner join (the window side can be broadcast; events stream without a
    # shuffle) + union of the windows themselves for matches without events
    inside = ev.join(windows, cond, "inner").select("match_id", "window_start", "window_end", "_id")
    empty = windows.select("match_id", "window_start", "window_end", F.lit(None).cast(ev.schema["_id"].dataType).alias("_id"))
    counted = inside.unionByName(empty).groupBy("match_id", "window_start", "window_end").agg(
        F.count("_id").alias("_n")
    )
    if fractional:
        minutes = (F.unix_micros(F.col("window_end").cast("timestamp")) - F.unix_micros(F.col("window_start").cast("timestamp"))) / 60e6
    else:
        minutes = whole_minutes("window_start", "window_end").cast("double")
    return counted.select("match_id", safe_divide("_n", minutes / 10).alias("baseline_app_events_10m"))


_MOMENT_COLS = ("event_id", "match_id", "event_ts", "minute", "event_type", "team_id", "player_id", "shot_outcome", "shot_xg")


def key_moment_engagement(match_events: DataFrame, app_events: DataFrame, minutes: int = 5) -> DataFrame:
    moments = key_moments(match_events).select(*_MOMENT_COLS)
    ev = app_events.select("match_id", "event_ts", "event_id", "user_id", "event_name")
    counts = window_counts(
        moments, ev, "match_id", "event_ts", "event_ts", minutes, minutes,
        counts={
            "app_events_plus_minus_5m": F.col("event_id").isNotNull(),
            "subscriptions_plus_minus_5m": F.col("event_name") == "subscription_start",
        },
        distinct={"users_plus_minus_5m": "user_id"},
    )
    base = baseline_rate(match_windows(match_events), app_events)
    j = counts.join(base, "match_id")
    return j.select(
        *_MOMENT_COLS, "app_events_plus_minus_5m", "users_plus_minus_5m", "subscriptions_plus_minus_5m",
        F.col("baseline_app_events_10m"),
        safe_divide("app_events_plus_minus_5m", "baseline_app_events_10m").alias("engagement_lift_vs_baseline"),
    )


def key_moments_report(
    match_events: DataFrame, app_events: DataFrame, matches: DataFrame, minutes: int = 5, keep_id: bool = False
) -> DataFrame:
    """Extract form: all shots, half-open windows, fractional-minute baseline,
    sorted by engagement (ties by match and event id). Fails if a match id occurs twice."""
    moments = key_moments(match_events, all_shots=True).select(*_MOMENT_COLS)
    ev = app_events.select("match_id", "event_ts", "event_id")
    counts = window_counts(
        moments, ev, "match_id", "event_ts", "event_ts", minutes, minutes,
        counts={"app_events_plus_minus_5m": F.col("event_id").isNotNull()}, half_open=True,
    )
    base = baseline_rate(match_windows(match_events), app_events, half_open=True, fractional=True)
    m = unique_by(matches.select("match_id", "competition_name", "home_team_name", "away_team_name"), ["match_id"], "matches")
    j = counts.join(base, "match_id").join(m, "match_id")
    j = j.select(
        "match_id", "minute", "event_type", "shot_outcome", "shot_xg", "team_id", "player_id",
        "app_events_plus_minus_5m", F.col("baseline_app_events_10m"),
        safe_divide("app_events_plus_minus_5m", "baseline_app_events_10m").alias("engagement_lift_vs_baseline"),
        "competition_name", "home_team_name", "away_team_name", match_label().alias("match_label"),
        "event_id",
    ).orderBy(F.desc("app_events_plus_minus_5m"), "match_id", "event_id")
    return j if keep_id else j.drop("event_id")


def moment_revenue_extremes(match_events: DataFrame, app_events: DataFrame, minutes: int = 5) -> DataFrame:
    """Per key moment: least and greatest payment, revenue, and the first and last event within ``minutes`` of it."""
    moments = key_moments(match_events).select("event_id", "match_id", "event_ts", "event_type")
    ev = app_events.select("match_id", "event_ts", "event_id", "event_name", "revenue_usd")
    paid = F.when(F.col("revenue_usd") != 0, F.col("revenue_usd"))
    return window_merged(
        moments, ev, "match_id", "event_ts", "event_ts", minutes, minutes, tiebreak="event_id",
        aggs={
            "least_payment_usd": ("min", paid), "greatest_payment_usd": ("max", paid), "revenue_usd": ("sum", F.col("revenue_usd")),
            "first_event": ("first", F.col("event_name")), "last_event": ("last", F.col("event_name")),
        })


def session_anchor_audit(app_events: DataFrame, match_events: DataFrame, minutes: int = 10) -> DataFrame:
    """Sessions whose start lies within ``minutes`` of a football event of one of
    the session's matches, with the nearest such anchor (ties: earlier anchor)."""
    starts = app_events.groupBy("session_id").agg(F.min("event_ts").alias("session_started_at"))
    pairs = app_events.select("session_id", "match_id").distinct().join(starts, "session_id")
    anchors = match_events.select("match_id", "event_ts")
    near = window_counts(
        pairs, anchors, "match_id", "session_started_at", "event_ts", minutes, minutes,
        counts={"anchors_within": F.lit(True)}, nearest="nearest_anchor_ts",
    )
    return near.where(F.col("anchors_within") > 0).select(
        "session_id", "match_id", "session_started_at", "nearest_anchor_ts",
        (F.abs(F.unix_micros(F.col("nearest_anchor_ts").cast("timestamp")) - F.unix_micros(F.col("session_started_at").cast("timestamp"))) / 1e6).alias("anchor_gap_seconds"),
        "anchors_within",
    )
