"""Data-quality suite: contract, key, reference, range, order and reconciliation checks.

All checks on keys, references, ranges and variants share one tagged row stream:
a table is read once and every row becomes (check, key, weight) rows, which one
two-stage aggregate turns into the figures of each check. A reference check is
the union of child and parent keys under one tag, so no join is needed, and hot
keys collapse in the partial aggregate. Only the order check has a plan of its
own. Only the result rows (a few dozen) reach the driver, and only when the
caller asks (``assert_valid``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fanpulse.functions.scalar import count_if
from fanpulse.schemas import CONTRACTS, PRIMARY_KEYS

RESULT_COLUMNS = ("check_name", "status", "observed", "expected", "checked_at")


class DataQualityError(ValueError):
    pass


def key_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(duplicates beyond the first per key with NULLs equal, rows with a NULL key part)
    in one two-stage aggregate (partial aggregation keeps hot keys cheap)."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(any_null, F.col("_c"))), F.lit(0)).alias("null_keys"),
    )


def backwards_in_order(
    df: DataFrame, group: str, order: str, value: str, bucket: Column | None = None
) -> DataFrame:
    """Rows whose ``value`` is smaller than the previous row's within ``group``
    ordered by ``order``. With ``bucket`` (monotone in ``order``) the window
    runs per (group, bucket), and each bucket's first row is compared with the
    last row of the group's previous bucket - one hot group never fills a task."""
    if bucket is None:
        w = Window.partitionBy(group).orderBy(order)
        return df.select((F.col(value) < F.lag(value).over(w)).alias("_back"))
    e = df.select(group, order, value, bucket.alias("_b"))
    last = e.groupBy(group, "_b").agg(F.max_by(F.col(value), F.col(order)).alias("_last"))
    prev = last.select(group, "_b", F.lag("_last").over(Window.partitionBy(group).orderBy("_b")).alias("_prev_last"))
    j = e.join(prev, [group, "_b"])
    w = Window.partitionBy(group, "_b").orderBy(order)
    before = F.coalesce(F.lag(value).over(w), F.col("_prev_last"))
    return j.select((F.col(value) < before).alias("_back"))


def backwards_count(df: DataFrame, group: str, order: str, value: str, pieces: int = 32) -> DataFrame:
    """One row ``observed``: how many rows have a smaller ``value`` than the row before them in ``order`` within ``group``.

    The order is cut at the quantiles of the whole table, so a group that holds a third of all rows is scanned by many
    tasks, one per piece. A piece hands over its first and last value; a second small window, of at most ``pieces`` rows a
    group, compares them across the borders. Orders that aren't numbers (or times) are scanned by group alone.
    """
    kind = dict(df.dtypes)[order]
    e = df.select(F.col(group).alias("_g"), F.col(order).alias("_o"), F.col(value).alias("_v"))
    if kind in ("bigint", "int", "smallint", "tinyint", "double", "float", "timestamp", "timestamp_ntz", "date"):
        cuts = e.agg(F.percentile_approx("_o", F.array(*[F.lit(k / pieces) for k in range(1, pieces)]), F.lit(1000))).scalar()
        e = e.withColumn("_c", F.coalesce(cuts, F.array().cast(f"array<{kind}>")))  # no subquery inside a lambda
        e = e.withColumn("_p", F.size(F.filter("_c", lambda c: c < F.col("_o")))).drop("_c")
    else:
        e = e.withColumn("_p", F.lit(0))
    w = Window.partitionBy("_g", "_p").orderBy("_o")
    e = e.withColumn("_back", F.col("_v") < F.lag("_v").over(w))
    ends = e.groupBy("_g", "_p").agg(count_if(F.col("_back")).alias("_n"), F.min_by("_v", "_o").alias("_first"), F.max_by("_v", "_o").alias("_last"))
    border = F.col("_first") < F.lag("_last").over(Window.partitionBy("_g").orderBy("_p"))
    return ends.select("_n", border.alias("_b")).agg((F.coalesce(F.sum("_n"), F.lit(0)) + count_if(F.col("_b"))).alias("observed"))


# ------------------------------------------------------------------ tagged stream
def _tag(check: str, keys: Sequence[Column] = (), n: int = 1, parent: bool = False) -> Column:
    key = F.array(*[k.cast("string") for k in keys]) if keys else F.array().cast("array<string>")
    return F.struct(F.lit(check).alias("check"), key.alias("key"), F.lit(n).cast("long").alias("n"), F.lit(parent).alias("parent"))


# check -> (child table, child column, parent table, parent column, rows with a NULL count)
REFERENCES: dict[str, tuple[str, str, str, str, bool]] = {
    "app_events.user_fk": ("fact_app_events", "user_id", "dim_users", "user_id", True),
    "app_events.date_fk": ("fact_app_events", "event_date", "dim_date", "date", True),
    "app_events.content_fk": ("fact_app_events", "content_id", "dim_content", "content_id", False),
    "app_events.match_fk": ("fact_app_events", "match_id", "dim_matches", "match_id", True),
    "content.match_fk": ("dim_content", "match_id", "dim_matches", "match_id", True),
    "match_events.match_fk": ("fact_match_events", "match_id", "dim_matches", "match_id", True),
}
KEY, RANGE, VARIANT = "key:", "match_events.xg_range", "experiment.no_crossover"


def _tags(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], checks: Sequence[str]) -> dict[str, list[Column]]:
    """The tagged rows that each table's rows become; a NULL is no row."""
    out: dict[str, list[Column]] = {}
    for table, columns in keys.items():
        out.setdefault(table, []).append(_tag(KEY + table, [F.col(c) for c in columns]))
    for check, (child, column, parent, parent_column, nulls) in REFERENCES.items():
        if check in checks and child in tables and parent in tables:
            row = _tag(check, [F.col(column)])
            out.setdefault(child, []).append(row if nulls else F.when(F.col(column).isNotNull(), row))
            out.setdefault(parent, []).append(F.when(F.col(parent_column).isNotNull(), _tag(check, [F.col(parent_column)], 0, True)))
    if RANGE in checks and "fact_match_events" in tables:
        xg = F.col("shot_xg")
        out.setdefault("fact_match_events", []).append(F.when(xg.isNotNull() & ~xg.between(0, 1), _tag(RANGE)))
    return out


def measured(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], checks: Sequence[str]) -> DataFrame:
    """One row per check of the stream: duplicates, null_keys, repeats (rows less distinct non-null keys), orphans, rows, mixed.

    ``keys``: tables whose keys are checked, with the key columns; ``checks``: reference, range and variant checks.
    """
    spark = next(iter(tables.values())).sparkSession
    tags = _tags(tables, keys, checks)
    stream = None
    for table, structs in tags.items():
        rows = tables[table].select(F.inline(F.array(*structs))).where("check is not null")
        stream = rows if stream is None else stream.unionByName(rows)
    null = F.exists("key", lambda k: k.isNull())
    figures = {
        "duplicates": F.col("n") - 1, "null_keys": F.when(null, F.col("n")), "repeats": F.col("n") - F.when(null, 0).otherwise(1),
        "orphans": F.when(~F.col("parent"), F.col("n")), "rows": F.col("n"), "mixed": F.lit(0),
    }
    names = [KEY + t for t in keys] + sorted(set(checks))
    zero = spark.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("check")) if names else spark.createDataFrame([], "check string")
    zero = zero.select("check", *[F.lit(0).cast("long").alias(f) for f in figures])  # a check over empty tables has figures too
    if stream is not None:
        per_key = stream.groupBy("check", "key").agg(F.sum("n").alias("n"), F.max("parent").alias("parent"))
        zero = zero.unionByName(per_key.select("check", *[e.cast("long").alias(f) for f, e in figures.items()]))
    if VARIANT in checks and "fact_experiment_assignments" in tables:  # apart: least and greatest texts need a sort, the stream is hashed
        arms = tables["fact_experiment_assignments"].groupBy("user_id", "experiment_name").agg((F.min("variant") != F.max("variant")).alias("_m")).where("_m")
        zero = zero.unionByName(arms.select(F.lit(VARIANT).alias("check"), *[F.lit(int(f == "mixed")).cast("long").alias(f) for f in figures]))
    return zero.groupBy("check").agg(*[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in figures])


def _results(found: DataFrame, wanted: Sequence[tuple[str, str, str, bool]]) -> DataFrame:
    """(check_name, observed, suite) of every wanted (result name, check, figure, suite) from the figures of ``measured``."""
    figures = [c for c in found.columns if c != "check"]
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.lit(c).alias("of"), F.lit(f).alias("figure"), F.lit(x).alias("suite")) for n, c, f, x in wanted])
    values = F.map_from_arrays(F.array(*map(F.lit, figures)), F.array(*map(F.col, figures)))
    own = found.select(F.explode(F.filter(rows, lambda r: r["of"] == F.col("check"))).alias("r"), values.alias("values"))
    return own.select("r.check_name", F.col("values")[F.col("r.figure")].alias("observed"), "r.suite")


def _suite_plan(tables, contracts, primary_keys):
    """(literal rows, key columns of checkable tables, wanted results) of the contract suite."""
    literal: list[tuple[str, str, str]] = []
    keys: dict[str, list[str]] = {}
    wanted: list[tuple[str, str, str, bool]] = []
    for table, schema in contracts.items():
        if table not in tables:
            literal.append((f"{table}.present", "0", "1"))
            continue
        df = tables[table]
        missing = sorted(set(schema.fieldNames()) - set(df.columns))
        literal.append((f"{table}.schema", ",".join(missing) if missing else "complete", "complete"))
        own = list(primary_keys[table])
        if set(own) <= set(df.columns):
            keys[table] = own
            wanted.append((f"{table}.primary_key_unique", KEY + table, "duplicates", True))
            wanted.append((f"{table}.primary_key_not_null", KEY + table, "null_keys", True))
        else:
            literal.append((f"{table}.primary_key_unique", "-1", "0"))
            literal.append((f"{table}.primary_key_not_null", "-1", "0"))
    wanted += [(c, c, "orphans", True) for c, (child, _, parent, _, _) in REFERENCES.items() if child in tables and parent in tables]
    if {"fact_match_events", "dim_matches"} <= set(tables.keys()):
        wanted.append((RANGE, RANGE, "rows", True))
    if "fact_experiment_assignments" in tables:
        wanted.append((VARIANT, VARIANT, "mixed", True))
    return literal, keys, wanted


def validate(
    tables: Mapping[str, DataFrame],
    spark: SparkSession | None = None,
    contracts=CONTRACTS,
    primary_keys=PRIMARY_KEYS,
    session_bucket: Column | None = None,
) -> DataFrame:
    """The contract suite: 3 rows per present table (1 FAIL row when missing),
    then the reference, range, order and crossover checks (39 rows on a full
    schema). Missing tables or columns produce FAIL rows, never analysis errors.
    """
    return _validated(tables, spark, contracts, primary_keys, session_bucket, ()).select("check_name", "status", "observed", "expected")


def _validated(tables, spark, contracts, primary_keys, session_bucket, more: Sequence[tuple[str, str, str, bool]]) -> DataFrame:
    """``validate`` with the column suite; ``more`` wanted results come from the same stream, with suite false."""
    if spark is None:
        spark = next(iter(tables.values())).sparkSession
    literal, keys, wanted = _suite_plan(tables, contracts, primary_keys)
    lit_rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.lit(o).alias("observed"), F.lit(e).alias("expected")) for n, o, e in literal])
    out = spark.range(1).select(F.inline(lit_rows)).withColumn("suite", F.lit(True))
    wanted += [*more]
    if wanted:
        found = _results(measured(tables, keys, [c for _, c, _, _ in wanted if not c.startswith(KEY)]), wanted)
        out = out.unionByName(found.select("check_name", F.col("observed").cast("string").alias("observed"), F.lit("0").alias("expected"), "suite"))
    if "fact_app_events" in tables:
        events = tables["fact_app_events"]
        if session_bucket is None:
            back = backwards_count(events, "session_id", "event_id", "event_ts")
        else:
            back = backwards_in_order(events, "session_id", "event_id", "event_ts", session_bucket).agg(count_if(F.col("_back")).alias("observed"))
        out = out.unionByName(back.select(
            F.lit("app_events.session_order").alias("check_name"), F.col("observed").cast("string").alias("observed"), F.lit("0").alias("expected"), F.lit(True).alias("suite")))
    return out.select("check_name", F.when(F.col("observed") == F.col("expected"), "PASS").otherwise("FAIL").alias("status"), "observed", "expected", "suite")


def with_checked_at(results: DataFrame, as_of: str | None = None) -> DataFrame:
    ts = F.lit(as_of).cast("timestamp_ntz") if as_of else F.current_timestamp().cast("timestamp_ntz")
    return results.withColumn("checked_at", ts)


def assert_valid(tables: Mapping[str, DataFrame], as_of: str | None = None, **kw) -> DataFrame:
    """Raise with ``name=observed; ...`` when any check fails, else return the
    results. Only failing rows are collected."""
    results = validate(tables, **kw)
    failures = results.where(F.col("status") == "FAIL").select("check_name", "observed").collect()
    if failures:
        detail = "; ".join(f"{r.check_name}={r.observed}" for r in failures)
        raise DataQualityError(f"Data quality failed: {detail}")
    return with_checked_at(results, as_of)


# --------------------------------------------------------------------------- M10
# result -> (check of the stream, figure)
_MART_RESULTS: dict[str, tuple[str, str]] = {
    "fact_app_events.duplicate_event_id": (KEY + "fact_app_events", "repeats"),
    "fact_match_events.invalid_xg": (RANGE, "rows"),
    "app_events.unknown_user": ("app_events.user_fk", "orphans"),
    "experiment.variant_crossover": (VARIANT, "mixed"),
}


def _reconciliation(app_events: DataFrame, product_daily: DataFrame) -> DataFrame:
    """|sum(fact) - sum(mart)| in cents: one aggregate over a signed union (no cross join)."""
    signed = app_events.select(F.col("revenue_usd").alias("_r")).unionByName(product_daily.select((-F.col("revenue_usd")).alias("_r")))
    return signed.agg(F.round(F.abs(F.sum("_r")) * 100).cast("long").alias("observed")).select(
        F.lit("product_daily.revenue_reconciliation").alias("check_name"), "observed")


def mart_checks(
    app_events: DataFrame,
    match_events: DataFrame,
    users: DataFrame,
    assignments: DataFrame,
    product_daily: DataFrame,
    as_of: str | None = None,
) -> DataFrame:
    """The five mart-level checks with integer observed values."""
    tables = {"fact_app_events": app_events, "fact_match_events": match_events, "dim_users": users, "fact_experiment_assignments": assignments}
    found = measured(tables, {"fact_app_events": ["event_id"]}, [c for c, _ in _MART_RESULTS.values() if not c.startswith(KEY)])
    out = _results(found, [(n, c, f, False) for n, (c, f) in _MART_RESULTS.items()]).drop("suite").unionByName(_reconciliation(app_events, product_daily))
    ts = F.lit(as_of).cast("timestamp_ntz") if as_of else F.current_timestamp().cast("timestamp_ntz")
    return out.select(
        "check_name",
        F.when(F.col("observed") == 0, "PASS").otherwise("FAIL").alias("status"),
        "observed", F.lit(0).cast("long").alias("expected"), ts.alias("checked_at"),
    )


def suite_and_mart_checks(tables: Mapping[str, DataFrame], product_daily: DataFrame) -> DataFrame:
    """check_name, status, observed, suite: the contract suite and the mart-level checks, from one stream."""
    more = [(n, c, f, False) for n, (c, f) in _MART_RESULTS.items()]
    both = _validated(tables, None, CONTRACTS, PRIMARY_KEYS, None, more).select("check_name", "status", F.col("observed").try_cast("long").alias("observed"), "suite")
    rec = _reconciliation(tables["fact_app_events"], product_daily)
    return both.unionByName(rec.select("check_name", F.when(F.col("observed") == 0, "PASS").otherwise("FAIL").alias("status"), "observed", F.lit(False).alias("suite")))


def mart_property_checks(events: DataFrame, daily: DataFrame, funnel: DataFrame) -> DataFrame:
    """Q14-Q16: revenue only on subscription events; MAU >= DAU; funnel never increases."""
    name = F.col("event_name")
    rev_bad = events.agg(count_if((F.col("revenue_usd") != 0) & ~name.isin("subscription_start", "subscription_cancel")).alias("o"))
    mau_bad = daily.agg(count_if(F.col("mau") < F.col("dau")).alias("o"))
    steps = ["notification_users", "match_center_users", "highlight_users", "subscription_users"]
    inc = None
    for a, b in zip(steps, steps[1:]):
        c = F.col(b) > F.col(a)
        inc = c if inc is None else (inc | c)
    fun_bad = funnel.agg(count_if(inc).alias("o"))
    parts = [("app_events.revenue_only_on_subscriptions", rev_bad), ("product_daily.mau_at_least_dau", mau_bad),
             ("funnel.never_increases", fun_bad)]
    out = None
    for n, d in parts:
        r = d.select(F.lit(n).alias("check_name"), F.when(F.col("o") == 0, "PASS").otherwise("FAIL").alias("status"),
                     F.col("o").cast("long").alias("observed"), F.lit(0).cast("long").alias("expected"))
        out = r if out is None else out.unionByName(r)
    return out
