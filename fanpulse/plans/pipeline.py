"""End-to-end job flows (no CLI): generate -> marts -> extracts.

* ``generate``       canonical tables -> quality gate (raises before writing)
                     -> Parquet with layout, manifest, CSV exports
* ``build_marts``    the ten marts in dependency order, each replaced in one commit:
                     a mart that fails leaves its last version readable; the
                     quality mart reads the *written* product-daily mart
* ``build_extracts`` report extracts as CSV plus one insights document
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanpulse.operators import quality
from fanpulse.plans import marts, reports
from fanpulse.sources import io, versions

Tables = Mapping[str, DataFrame]

# file order of the marts; the quality mart depends on the product-daily mart
MART_ORDER: tuple[str, ...] = (
    "mart_sessions", "mart_product_daily", "mart_retention_cohort", "mart_conversion_funnel",
    "mart_sports_engagement", "mart_football_team_match", "mart_key_moment_engagement",
    "mart_marketing_economics", "mart_ab_test_match_center_v2", "mart_data_quality",
)


def generate(tables: Tables, out: str, as_of: str | None = None) -> dict[str, int]:
    """Validate, then write every table with its layout plus manifest and exports."""
    results = quality.assert_valid(tables, as_of=as_of)
    io.write_tables({"data_quality_results": results}, out)
    counts = io.write_with_layout(tables, out)
    spark = results.sparkSession
    spark.createDataFrame(list(counts.items()), "table string, rows long").coalesce(1).write.mode("overwrite").json(f"{out}/manifest")
    io.export_campaign_targets(tables["fact_campaign_spend"], f"{out}/campaign_targets_csv")
    io.export_event_sample(tables["fact_app_events"], f"{out}/event_sample_csv")
    return counts


def build_marts(tables: Tables, out: str, as_of: str | None = None) -> dict[str, str]:
    spark = next(iter(tables.values())).sparkSession
    written: dict[str, str] = {}
    builders: dict[str, Callable[[Tables], DataFrame]] = dict(marts.MARTS)
    for name in MART_ORDER:
        if name == "mart_data_quality":
            daily = spark.read.parquet(written["mart_product_daily"])
            df = quality.mart_checks(
                tables["fact_app_events"], tables["fact_match_events"], tables["dim_users"],
                tables["fact_experiment_assignments"], daily, as_of=as_of)
        else:
            df = builders[name](tables)
        io.write_table(df, out, name)
        written[name] = versions.folder(spark, f"{out}/{name}")
    return written


EXTRACTS: dict[str, Callable[[Tables], DataFrame]] = {
    "executive_daily": reports.r1, "retention": reports.r2, "funnel": reports.r3,
    "sports_engagement": reports.r4, "marketing": reports.r5, "ab_test": reports.r6_,
    "key_moments": reports.r7, "quality": reports.r8,
}


def build_extracts(tables: Tables, out: str) -> DataFrame:
    """Write the CSV extracts and the insights document; return the record, which nothing computes until it is read."""
    extracts = {name: fn(tables) for name, fn in EXTRACTS.items()}
    io.export_extracts(extracts, out)
    charts = {  # each with the order of its array
        "executive_daily": (extracts["executive_daily"], ["event_date"]),
        "funnel": (extracts["funnel"], ["platform", "experiment_variant"]),
        "retention": (extracts["retention"], ["acquisition_channel", "platform"]),
        "sports": (reports.r9(tables), [-F.col("unique_viewers"), "match_label"]),
        "marketing": (extracts["marketing"], ["channel"]), "ab_test": (extracts["ab_test"], ["variant"]),
        "key_moments": (reports.key_moments_top12(tables), [-F.col("app_events_plus_minus_5m"), "match_id", "minute"]),
    }
    tops = {"top_match": reports.r11_top_match(tables), "best_channel": reports.r11_best_channel(tables),
            "top_moment": reports.r11_top_moment(tables)}
    kpis, sources = reports.r10(tables), reports.r12(tables)
    io.write_insights_document(kpis, sources, charts, tops, f"{out}/insights")
    return io.insights_record(kpis, sources, charts, tops)


def chart_sizes(record: DataFrame) -> DataFrame:
    return record.select(*[F.size(f"charts.{c}").alias(c) for c in record.schema["charts"].dataType.names])
