import json
import os

from pyspark.sql import functions as F

from fanpulse.sources import versions
from fanpulse.sources.io import (export_event_sample, insights_record, manifest, read_campaign_targets, read_insights,
                                 read_layout_table, write_insights, write_insights_document, write_with_layout)


def test_write_with_layout_roundtrip(tables, tmp_path):
    out = str(tmp_path / "wh")
    sub = {k: tables[k] for k in ("fact_app_events", "fact_match_events", "dim_users", "dim_matches")}
    counts = write_with_layout(sub, out)
    assert set(counts) == set(sub)                        # no table given is left out
    assert counts["dim_users"] == tables["dim_users"].count()
    assert counts["fact_app_events"] == tables["fact_app_events"].count()
    folder = versions.folder(tables["fact_app_events"].sparkSession, f"{out}/fact_app_events")
    assert os.path.isdir(f"{folder}/event_date=2024-01-01")
    back = read_layout_table(tables["fact_app_events"].sparkSession, out, "fact_match_events")
    assert set(back.columns) == set(tables["fact_match_events"].columns)
    plan = back.where(F.col("event_ts_day") == F.lit("2024-01-02").cast("date")) if "event_ts_day" in back.columns else None
    assert plan is None


def test_manifest_and_sample(tables, tmp_path):
    m = {r.table: r.rows for r in manifest({k: tables[k] for k in ("dim_users", "dim_matches")}).collect()}
    assert m["dim_matches"] == 10 and m["dim_users"] == tables["dim_users"].count()
    export_event_sample(tables["fact_app_events"], str(tmp_path / "sample"), n=10)
    rows = tables["fact_app_events"].sparkSession.read.option("header", True).csv(str(tmp_path / "sample")).collect()
    assert sorted(int(r.event_id) for r in rows) == list(range(10))


def test_insights_nan_to_null(spark, tmp_path):
    kpis = spark.createDataFrame([(1, float("nan"))], "peak_dau long, ab_relative_lift double")
    src = spark.createDataFrame([(10, 2)], "app_events long, matches long")
    chart = spark.createDataFrame([("a", 1.0), ("b", float("nan"))], "k string, v double")
    rec = insights_record(kpis, src, {"c": (chart, [chart.columns[0]])}, {"top": chart.limit(1)})
    write_insights(rec, str(tmp_path / "ins"))
    f = [p for p in os.listdir(tmp_path / "ins") if p.endswith(".json")][0]
    doc = json.loads(open(tmp_path / "ins" / f).read())
    assert "ab_relative_lift" not in doc["kpis"] or doc["kpis"]["ab_relative_lift"] is None
    assert doc["generated_from"]["matches"] == 2 and len(doc["charts"]["c"]) == 2


def _document(path):
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    texts = [open(f"{path}/{f}").read() for f in parts]
    return json.loads("".join(texts)), [t.count("\n") for t in texts]


def test_insights_document_of_a_million_entries(spark, tmp_path):
    n, path = 1_000_000, str(tmp_path / "ins")
    kpis = spark.createDataFrame([(1, float("nan"))], "peak_dau long, ab_relative_lift double")
    src = spark.createDataFrame([(10, 2)], "app_events long, matches long")
    long = spark.range(n).select((F.lit(n) - F.col("id")).alias("rank"), F.concat(F.lit('a "b", \n'), F.col("id") % 7).alias("label")).repartition(6)
    ties = spark.createDataFrame([("x", 2), ("y", 1), ("x", 2), (None, None)], "k string, v long")
    empty = ties.limit(0)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_insights_document(kpis, src, {"long": (long, ["rank"]), "none": (empty, ["k"]), "ties": (ties, [-F.col("v")])}, {"top": ties.where("k = 'y'"), "no_top": empty}, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    doc, lines = _document(f"{path}/document")
    assert len(lines) > 2 and max(lines) < n                      # no part, so no task, holds the chart whole
    assert doc["kpis"] == {"peak_dau": 1, "ab_relative_lift": None} and doc["generated_from"] == {"app_events": 10, "matches": 2}
    assert doc["top"] == {"k": "y", "v": 1} and doc["no_top"] is None and list(doc["charts"]) == ["long", "none", "ties"]
    assert [r["rank"] for r in doc["charts"]["long"]] == list(range(1, n + 1)) and doc["charts"]["long"][-1]["label"] == 'a "b", \n0'
    assert doc["charts"]["none"] == [] and doc["charts"]["ties"] == [{"k": None, "v": None}, {"k": "x", "v": 2}, {"k": "x", "v": 2}, {"k": "y", "v": 1}]
    entries = read_insights(spark, path)
    assert entries.where("chart = 'long'").agg(F.min("position"), F.max("position"), F.count_distinct("position"), F.max("of")).first()[:] == (0, n - 1, n, n)


def test_read_campaign_targets(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("channel,target_spend_usd,target_cac_usd,target_roas_30d\nsocial,57780,9,1.20\n")
    r = read_campaign_targets(spark, str(p)).collect()[0]
    assert r.channel == "social" and r.target_roas_30d == 1.2


def test_checkpoint_dir_comes_from_session(spark):
    from fanpulse.session import ensure_checkpoint_dir, scale_conf

    d = ensure_checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
    conf = scale_conf(100 << 40, 1000, 8)
    assert int(conf["spark.sql.shuffle.partitions"]) == 102400
    assert int(scale_conf(1 << 30, 10, 4)["spark.sql.shuffle.partitions"]) == 80
