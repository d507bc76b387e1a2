"""Inactivity sessionization and the per-session rollup.

A new session starts at a key's first event or when the gap to the previous
event (ordered by time, then tiebreak) is more than ``gap_minutes`` *whole*
minutes (truncating, so a 30m59s gap stays in the session).

Scale design: events are first aggregated to time bins of the gap's width, which
no session break can fall into; only windows over a key's bins are partitioned
by key. ``sessionize_single_window`` is the textbook one-window form, kept as the
reference in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fanpulse.functions.scalar import bin_of, count_if, first_by_time, whole_minutes, whole_seconds

_UNB = Window.unboundedPreceding


def _numbered_bins(bins: DataFrame, key: str, b: str, gap_minutes: int) -> DataFrame:
    """Adds ``_new`` and ``_number`` to bins with ``_first_ts`` and ``_last_ts``: a bin starts a session when the gap to
    the key's bin before is too long. At most a row per ``gap_minutes`` and key, whatever the key's event volume."""
    w = Window.partitionBy(key).orderBy(b)
    before = F.lag("_last_ts").over(w)
    new = F.when(before.isNull() | (whole_minutes(before, F.col("_first_ts")) > gap_minutes), 1).otherwise(0)
    return bins.withColumn("_new", new).withColumn("_number", F.sum("_new").over(w.rowsBetween(_UNB, 0)).cast("long"))


def sessionize(
    events: DataFrame,
    key: str = "user_id",
    ts: str = "event_ts",
    tiebreak: str = "event_id",
    gap_minutes: int = 30,
    number_col: str = "derived_session_number",
    flag_col: str = "is_new_session",
) -> DataFrame:
    """Return ``events`` with ``is_new_session`` (0/1) and the session number per key. NULL keys are one key.

    The numbers come from the bins; an event takes its bin's number, and the first event of a starting bin is the new
    session's first."""
    b = "_bin"
    e = events.withColumn(b, bin_of(ts, gap_minutes * 60))
    bins = e.groupBy(key, b).agg(F.min(ts).alias("_first_ts"), F.max(ts).alias("_last_ts"))
    bins = _numbered_bins(bins, key, b, gap_minutes).select(F.col(key).alias("_k"), F.col(b).alias("_b"), "_new", "_number")
    j = e.join(bins, F.col(key).eqNullSafe(F.col("_k")) & (F.col(b) == F.col("_b")))
    first = F.row_number().over(Window.partitionBy(key, b).orderBy(ts, tiebreak)) == 1
    return j.withColumn(flag_col, F.when(first, F.col("_new")).otherwise(0)).withColumn(number_col, F.col("_number")).drop(
        b, "_k", "_b", "_new", "_number")


def sessionize_single_window(
    events: DataFrame,
    key: str = "user_id",
    ts: str = "event_ts",
    tiebreak: str = "event_id",
    gap_minutes: int = 30,
    number_col: str = "derived_session_number",
    flag_col: str = "is_new_session",
) -> DataFrame:
    """Textbook form (one window per key); kept as the reference for tests."""
    w = Window.partitionBy(key).orderBy(ts, tiebreak)
    prev = F.lag(F.col(ts)).over(w)
    e = events.withColumn(
        flag_col, F.when(prev.isNull() | (whole_minutes(prev, F.col(ts)) > gap_minutes), 1).otherwise(0)
    )
    return e.withColumn(number_col, F.sum(flag_col).over(w.rowsBetween(_UNB, 0)).cast("long"))


def derived_sessions(
    events: DataFrame,
    key: str = "user_id",
    ts: str = "event_ts",
    tiebreak: str = "event_id",
    gap_minutes: int = 30,
) -> DataFrame:
    """Session mart directly from events.

    Two events in the same bin of ``gap_minutes`` are never split, so a bin is atomic: events are aggregated to
    (key, bin) with map-side combine, a window over a key's bins numbers the sessions, and bins are rolled up. Two
    exchanges, no event-level sort; a hot key costs a row per bin and task. NULL keys are one key."""
    name = F.col("event_name")
    b = "_bin"
    e = events.withColumn(b, bin_of(ts, gap_minutes * 60))
    bins = e.groupBy(key, b).agg(
        F.min(ts).alias("_first_ts"),
        F.max(ts).alias("_last_ts"),
        F.min(F.struct(F.col(ts).alias("t"), F.col(tiebreak).alias("k"), F.col("match_id").alias("m"))).alias("_first"),
        F.count(F.lit(1)).alias("_n"),
        F.collect_set(name).alias("_names"),
        F.bool_or(name == "match_center_view").alias("_mc"),
        F.bool_or(name == "highlight_view").alias("_hl"),
        F.bool_or(name == "subscription_start").alias("_conv"),
        F.sum("revenue_usd").alias("_rev"),
    )
    numbered = _numbered_bins(bins, key, b, gap_minutes).withColumnRenamed("_number", "derived_session_number")
    g = numbered.groupBy(key, "derived_session_number").agg(
        F.min("_first").alias("_first"),
        F.min("_first_ts").alias("session_started_at"),
        F.max("_last_ts").alias("session_ended_at"),
        F.sum("_n").alias("event_count"),
        F.size(F.array_distinct(F.flatten(F.collect_list("_names")))).cast("long").alias("unique_event_types"),
        F.bool_or("_mc").alias("viewed_match_center"),
        F.bool_or("_hl").alias("viewed_highlight"),
        F.bool_or("_conv").alias("converted"),
        F.sum("_rev").alias("net_revenue_usd"),
    )
    return g.select(
        F.concat(F.col(key).cast("string"), F.lit("-"), F.col("derived_session_number").cast("string")).alias("derived_session_id"),
        key,
        F.col("_first.m").alias("match_id"),
        F.to_date("session_started_at").alias("event_date"),
        "session_started_at",
        "session_ended_at",
        whole_seconds("session_started_at", "session_ended_at").alias("duration_seconds"),
        "event_count",
        "unique_event_types",
        "viewed_match_center",
        "viewed_highlight",
        "converted",
        "net_revenue_usd",
    )


def session_rollup(
    sessions: DataFrame,
    key: str = "user_id",
    ts: str = "event_ts",
    tiebreak: str = "event_id",
    number_col: str = "derived_session_number",
) -> DataFrame:
    """One row per derived session (the session mart)."""
    name = F.col("event_name")
    g = sessions.groupBy(key, number_col).agg(
        first_by_time("match_id", ts, tiebreak).alias("match_id"),
        F.min(ts).alias("session_started_at"),
        F.max(ts).alias("session_ended_at"),
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct(name).alias("unique_event_types"),
        F.bool_or(name == "match_center_view").alias("viewed_match_center"),
        F.bool_or(name == "highlight_view").alias("viewed_highlight"),
        F.bool_or(name == "subscription_start").alias("converted"),
        F.sum("revenue_usd").alias("net_revenue_usd"),
    )
    return g.select(
        F.concat(F.col(key).cast("string"), F.lit("-"), F.col(number_col).cast("string")).alias("derived_session_id"),
        key,
        "match_id",
        F.to_date("session_started_at").alias("event_date"),
        "session_started_at",
        "session_ended_at",
        whole_seconds("session_started_at", "session_ended_at").alias("duration_seconds"),
        "event_count",
        "unique_event_types",
        "viewed_match_center",
        "viewed_highlight",
        "converted",
        "net_revenue_usd",
    )


__all__ = ["sessionize", "sessionize_single_window", "session_rollup", "derived_sessions", "count_if"]
