"""Aggregates over time windows and spans without joins that pair them with the rows inside them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fanpulse.functions.scalar import add_minutes, bin_of

#: How partial results of an aggregate are merged; ``first`` and ``last`` are least and greatest (time, tiebreak, value).
MERGE = {"min": F.min, "max": F.max, "sum": F.sum, "first": F.min, "last": F.max}


def window_merged(
    moments: DataFrame,
    events: DataFrame,
    key: str,
    moment_ts: str,
    event_ts: str,
    before_minutes: int,
    after_minutes: int,
    aggs: Mapping[str, tuple[str, Column]],
    tiebreak: str,
    half_open: bool = False,
) -> DataFrame:
    """For every moment, aggregates over the events of its ``key`` with ``moment - before <= event <= moment + after``
    (``< moment + after`` when ``half_open``) that cannot be had by subtracting running sums.

    ``aggs``: name -> (kind, value), kinds as in ``MERGE``: ``min``, ``max`` and ``sum`` of the value (NULLs left out),
    ``first`` and ``last`` value by event time, ties by ``tiebreak``.

    Time is cut into bins as long as the window, so a window is the end of one bin and the beginning of the next:
    its result merges a running aggregate taken backwards over the one with a running aggregate taken forwards over
    the other. Both ends of a window lie on the timeline of the events, one row per distinct event time, partitioned
    by (key, bin): no (moment, event) pair is made, and a hot key is split by time. Work grows with distinct event
    times plus moments. Moments keep their rows and columns; one without events, or with a NULL key or time, gets NULLs.
    """
    if before_minutes + after_minutes <= 0:
        raise ValueError("a window needs a length")
    width = (before_minutes + after_minutes) * 60
    names = [f"_p{i}" for i in range(len(aggs))]
    merges = [MERGE[kind] for kind, _ in aggs.values()]
    timed = [kind in ("first", "last") for kind, _ in aggs.values()]

    def partial(kind: str, value: Column) -> Column:
        stamped = F.struct(F.col(event_ts).alias("_ts"), F.col(tiebreak).alias("_tie"), value.alias("_value"))
        return MERGE[kind](stamped if kind in ("first", "last") else value)

    known = events.where(F.col(key).isNotNull() & F.col(event_ts).isNotNull())
    atoms = known.groupBy(F.col(key).alias("_k"), F.col(event_ts).alias("_t")).agg(
        *[partial(kind, value).alias(n) for n, (kind, value) in zip(names, aggs.values())])

    # order at one time: a window's begin, an open end, the events, a closed end
    begin, event, end = 0, 2, 1 if half_open else 3
    times = moments.where(F.col(key).isNotNull() & F.col(moment_ts).isNotNull()).select(
        F.col(key).alias("_k"), F.col(moment_ts).alias("_m")).distinct()
    ends = F.array(F.struct(add_minutes("_m", -before_minutes).alias("_t"), F.lit(begin).alias("_step")),
                   F.struct(add_minutes("_m", after_minutes).alias("_t"), F.lit(end).alias("_step")))
    points = times.select("_k", "_m", F.inline(ends))
    line = atoms.withColumn("_step", F.lit(event)).unionByName(points, allowMissingColumns=True)
    line = line.withColumn("_bin", bin_of("_t", width))

    # backwards is an order of its own: frames that reach to the end of a partition are recomputed for every row
    to_here = (Window.unboundedPreceding, Window.currentRow)
    forwards = Window.partitionBy("_k", "_bin").orderBy("_t", "_step").rowsBetween(*to_here)
    backwards = Window.partitionBy("_k", "_bin").orderBy(F.desc("_t"), F.desc("_step")).rowsBetween(*to_here)
    halves = line.select("_k", "_m", *[
        F.when(F.col("_step") == begin, merge(n).over(backwards)).otherwise(merge(n).over(forwards)).alias(n)
        for n, merge in zip(names, merges)]).where(F.col("_m").isNotNull())
    found = halves.groupBy("_k", "_m").agg(*[merge(n).alias(n) for n, merge in zip(names, merges)])
    j = moments.join(found, (moments[key] == F.col("_k")) & (moments[moment_ts] == F.col("_m")), "left")
    return j.select(*[moments[c] for c in moments.columns],
                    *[(F.col(n)["_value"] if t else F.col(n)).alias(name) for name, n, t in zip(aggs, names, timed)])


def span_sums(
    spans: DataFrame, amounts: DataFrame, key: str, first: str, last: Column, at: str, amount: str, name: str
) -> DataFrame:
    """Every span with the sum of ``amount`` over the rows of its ``key`` with ``first <= at <= last``; 0 without such rows.

    A key's amounts are laid side by side in one array, which the spans look up by key alone: an equi-join that keeps the
    number of spans, takes inputs in buckets of the key without an exchange, and adds exactly the amounts inside (in the
    order of ``at``, so reruns agree). ``amounts`` should have at most one row per (key, ``at``), and so an array at most
    as long as the calendar. A span whose key or ends are NULL gets 0; amounts without key or time count nowhere.
    """
    known = amounts.where(F.col(key).isNotNull() & F.col(at).isNotNull() & F.col(amount).isNotNull())
    by_key = known.groupBy(F.col(key).alias("_key")).agg(F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), F.col(amount).alias("x")))).alias("_amounts"))
    j = spans.withColumn("_last", last).join(by_key, F.col(key) == F.col("_key"), "left")
    inside = F.filter("_amounts", lambda a: (a["at"] >= F.col(first)) & (a["at"] <= F.col("_last")))
    total = F.aggregate(inside, F.lit(0.0), lambda acc, a: acc + a["x"])
    return j.select(*spans.columns, F.coalesce(total, F.lit(0.0)).alias(name))
