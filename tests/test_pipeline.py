import os

from pyspark.sql import functions as F

from fanpulse.plans.pipeline import MART_ORDER, build_extracts, build_marts, chart_sizes, generate


def test_generate_marts_extracts(tables, tmp_path):
    t = dict(tables.items())
    out = str(tmp_path / "warehouse")
    counts = generate(t, out, as_of="2024-02-01 00:00:00")
    assert counts["fact_app_events"] == tables["fact_app_events"].count()
    spark = tables["fact_app_events"].sparkSession
    man = {r.table: r.rows for r in spark.read.json(f"{out}/manifest").collect()}
    assert man["dim_matches"] == 10
    written = build_marts(t, str(tmp_path / "marts"), as_of="2024-02-01 00:00:00")
    assert list(written) == list(MART_ORDER)
    dq = spark.read.parquet(written["mart_data_quality"])
    assert dq.where("status = 'PASS'").count() == 5
    assert any(f.startswith("event_date=") for f in os.listdir(written["mart_sessions"]))
    record = build_extracts(t, str(tmp_path / "extracts"))
    sizes = chart_sizes(record).collect()[0].asDict()
    assert sizes["key_moments"] <= 12 and sizes["funnel"] == 6
    row = record.select("charts.executive_daily", "charts.sports").first()
    assert [r.event_date for r in row.executive_daily] == sorted(r.event_date for r in row.executive_daily)
    viewers = [r.unique_viewers for r in row.sports]
    assert viewers == sorted(viewers, reverse=True)
    assert os.path.isdir(tmp_path / "extracts" / "insights")
    assert record.select(F.col("kpis.peak_dau")).first()[0] > 0
