"""Query registry: name -> builder over canonical tables, plus the oracle SQL.

``spark_query(name)`` returns a ``(spark, sf_dir) -> DataFrame`` callable. The
canonical tables are lazy plans over the raw Parquet files of ``sf_dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanpulse.plans import marts
from fanpulse.plans.oracle import AS_OF, SQL
from fanpulse.sources.bindings import canonical_tables

Tables = dict[str, DataFrame]


def conversion_on_test_data():
    """Conversion event on the test data (nearly every active user purchases)."""
    return (F.col("event_name") == "subscription_start") & (F.col("value") > 150)


BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {
    "mart_sessions": marts.mart_sessions,
    "mart_product_daily": marts.mart_product_daily,
    "mart_retention_cohort": marts.mart_retention_cohort,
    "mart_conversion_funnel": marts.mart_conversion_funnel,
    "mart_sports_engagement": marts.mart_sports_engagement,
    "mart_football_team_match": marts.mart_football_team_match,
    "mart_key_moment_engagement": marts.mart_key_moment_engagement,
    "mart_marketing_economics": marts.mart_marketing_economics,
    "mart_ab_test_match_center_v2": lambda t: marts.experiment.ab_test_mart(
        t["fact_experiment_assignments"], t["fact_app_events"], conversion=conversion_on_test_data()),
    "mart_data_quality": lambda t: marts.mart_data_quality(t, as_of=AS_OF),
}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Tables], DataFrame]):
        BUILDERS[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# Driver-facing outputs carry dates as midnight timestamps on both engines, so
# the two results convert to identical Python/pandas values (a DATE column
# becomes datetime.date on one side and datetime64 on the other otherwise).
DATE_OUTPUTS = ("date", "event_date", "metric_date", "cohort_date", "funnel_date", "match_date")


def comparable(df: DataFrame) -> DataFrame:
    """Dates as midnight timestamps; doubles to 6 places, so that no result depends on the order of a sum.

    This is the only place that rounds: operators and decisions work on exact values."""
    def edge(f):
        kind = f.dataType.typeName()
        if kind == "date":
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.round(f.name, 6).alias(f.name) if kind == "double" else F.col(f.name)

    return df.select(*map(edge, df.schema.fields))


def oracle_dates_as_timestamps(sql: str, columns) -> str:
    present = [c for c in DATE_OUTPUTS if c in columns]
    if not present:
        return sql
    repl = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in present)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    builder = BUILDERS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(builder(canonical_tables(spark, sf_dir)))

    run.__name__ = name
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_extensions()
    return {name: spark_query(name) for name in BUILDERS}


# date columns of each query's result (kept in sync by tests/test_oracle.py)
ORACLE_DATE_COLUMNS: dict[str, tuple[str, ...]] = {
    "bucketed_user_economics": ("metric_date",), "date_dimension": ("date",), "ingest_last_matches": ("match_date",), "ingest_matches": ("match_date",), "mart_conversion_funnel": ("funnel_date",),
    "mart_football_team_match": ("match_date",), "mart_marketing_economics": ("metric_date",),
    "mart_product_daily": ("metric_date",), "mart_retention_cohort": ("cohort_date",),
    "mart_sessions": ("event_date",), "mart_sports_engagement": ("match_date",), "metric_selector": ("event_date",),
    "report_executive_daily": ("event_date",), "report_sports_engagement": ("match_date",),
}


def all_oracles() -> dict[str, str]:
    _load_extensions()
    return {name: oracle_dates_as_timestamps(sql, ORACLE_DATE_COLUMNS.get(name, ()))
            for name, sql in SQL.items() if name in BUILDERS}


def _load_extensions() -> None:
    # report / dashboard / primitive queries register themselves on import
    from fanpulse.plans import ingest_queries, layout_queries, reports  # noqa: F401
