"""Parquet / CSV / JSON sources and sinks.

* ``read_tables``      - load named Parquet tables, the committed version where they are versioned (S1)
* ``write_tables``     - one Parquet dataset per table, replaced atomically (S7)
* ``write_with_layout``- date partitions + sorted (clustered) files, replaced atomically, returns row counts (S11)
* ``replace_dates``    - replay of some dates of such a table; all other dates keep their files
* ``export_*``         - CSV extracts, manifest (S8-S10, S13)
* ``write_insights_document`` - the insights record as one JSON document in ordered parts (S14)
* ``read_campaign_targets`` - target sheet CSV with an explicit schema (S15)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fanpulse.operators.marketing import TARGET_SCHEMA
from fanpulse.schemas import LAYOUT, PRIMARY_KEYS
from fanpulse.session import ensure_checkpoint_dir
from fanpulse.sources import versions


#: Exports keep a timestamp's microseconds (the CSV writer's own format ends at milliseconds).
CSV = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def read_tables(spark: SparkSession, path: str, names: Iterable[str]) -> dict[str, DataFrame]:
    at = {name: f"{path}/{name}" for name in names}
    return {name: versions.read(spark, p) if versions.numbers(spark, p) else spark.read.parquet(p) for name, p in at.items()}


def write_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        versions.write(df, f"{path}/{name}")


def layout_plan(df: DataFrame, table: str) -> tuple[DataFrame, list[str]]:
    """Apply a table's physical layout; return (frame to write, partition columns).

    ``REBALANCE`` on the date partition column: rows of a day go to the same
    writers (few files per date directory) while AQE splits a hot day into
    several advisory-sized tasks and merges small ones - without the extra
    sampling pass over the input that range partitioning needs. The sort on
    (date, cluster columns) inside each task gives Parquet min/max statistics
    that prune row groups.
    """
    spec = LAYOUT.get(table, {})
    part = spec.get("partition")
    clusters = list(spec.get("clusters", []))
    parts: list[str] = []
    if part and spec.get("day"):
        df = df.withColumn(f"{part}_day", F.to_date(part))
        part = f"{part}_day"
    if part:
        parts = [part]
    order = parts + clusters
    if order:
        df = (df.hint("rebalance", *parts) if parts else df.hint("rebalance")).sortWithinPartitions(*order)
    return df, parts


def write_table(df: DataFrame, path: str, table: str, only_touched: bool = False) -> dict:
    """Write one table with its layout and commit it; the manifest of the new version."""
    out, parts = layout_plan(df, table)
    keys = [k for k in PRIMARY_KEYS.get(table, ()) if k in df.columns]
    return versions.write(out, f"{path}/{table}", parts, only_touched, keys)


def write_with_layout(tables: Mapping[str, DataFrame], path: str) -> dict[str, int]:
    """Write every table given, with its layout where it has one; return the row count of each, taken while writing."""
    return {name: write_table(df, path, name)["metrics"]["rows"] for name, df in tables.items()}


def replace_dates(df: DataFrame, path: str, table: str) -> dict:
    """Replay: the dates that ``df`` has rows of are replaced by them, in one commit; other dates stay as they are."""
    return write_table(df, path, table, only_touched=True)


def read_layout_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The committed rows of a table written by ``write_with_layout``, in its contract shape.

    A filter on the timestamp of a table partitioned by its day is no filter on the folders: ``day_range`` adds one.
    """
    df = versions.read(spark, f"{path}/{table}")
    spec = LAYOUT.get(table, {})
    return df.drop(f"{spec['partition']}_day") if spec.get("day") else df


def day_range(spark: SparkSession, path: str, table: str, first: str, last: str) -> DataFrame:
    """Rows of the days ``first`` to ``last``, both included; only their folders are read."""
    spec = LAYOUT[table]
    day = f"{spec['partition']}_day" if spec.get("day") else spec["partition"]
    df = versions.read(spark, f"{path}/{table}").where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return df.drop(day) if spec.get("day") else df


def layout_manifest(spark: SparkSession, path: str, names: Iterable[str]) -> DataFrame:
    """table, version, rows, null_keys, folders: what the writers of the committed versions counted; no table is read."""
    rows = []
    for name in names:
        m = versions.manifest(spark, f"{path}/{name}")
        rows.append((name, m["version"], m["metrics"]["rows"], m["metrics"]["null_keys"], len(m["folders"])))
    return spark.createDataFrame(rows, "table string, version long, rows long, null_keys long, folders long")


def export_campaign_targets(spend: DataFrame, path: str) -> None:
    spend.select("spend_date", "channel", "target_spend_usd").write.mode("overwrite").option("header", True).csv(path)


def export_event_sample(events: DataFrame, path: str, n: int = 5000) -> None:
    """First ``n`` events by event id (explicit order: files have none)."""
    events.orderBy("event_id").limit(n).write.mode("overwrite").options(**CSV).csv(path)


def manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table as one small frame (one count job per table, unioned)."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def write_manifest(tables: Mapping[str, DataFrame], path: str) -> None:
    manifest(tables).coalesce(1).write.mode("overwrite").json(path)


def export_extracts(extracts: Mapping[str, DataFrame], path: str) -> None:
    for name, df in extracts.items():
        df.write.mode("overwrite").options(**CSV).csv(f"{path}/{name}")


def nan_safe(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column before JSON serialisation."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            cols.append(F.when(F.isnan(f.name), F.lit(None)).otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def insights_record(
    kpis: DataFrame, sources: DataFrame, charts: Mapping[str, tuple[DataFrame, Sequence[str | Column]]], tops: Mapping[str, DataFrame]
) -> DataFrame:
    """One nested record: generated_from, kpis, top_* and charts, with an array per chart.

    ``charts``: name -> (rows, order); an array is sorted by that order, as ``collect_list`` promises none.

    For small charts only (top-k or per-day extracts): an array is one value, built
    by ``collect_list``; ``write_insights_document`` takes charts of any length. The
    one-row parts are combined by a union + ``first(ignorenulls)`` aggregate (no join).
    """
    parts = [nan_safe(sources).select(F.struct("*").alias("generated_from")),
             nan_safe(kpis).select(F.struct("*").alias("kpis"))]
    for name, df in tops.items():
        parts.append(nan_safe(df).agg(F.first(F.struct("*")).alias(name)))
    for name, (df, order) in charts.items():
        keys = F.struct(*[(F.col(k) if isinstance(k, str) else k).alias(f"_{i}") for i, k in enumerate(order)])
        rows = nan_safe(df).select(F.struct(keys.alias("_order"), F.struct("*").alias("_row")).alias("_chart"))
        parts.append(rows.agg(F.transform(F.array_sort(F.collect_list("_chart")), lambda r: r["_row"]).alias(f"chart_{name}")))
    fields = [(p.columns[0], p.schema[p.columns[0]].dataType) for p in parts]
    out = None
    for p in parts:
        own = p.columns[0]
        row = p.select(*[F.col(n) if n == own else F.lit(None).cast(t).alias(n) for n, t in fields])
        out = row if out is None else out.unionByName(row)
    out = out.agg(*[F.first(n, ignorenulls=True).alias(n) for n, _ in fields])
    plain = [n for n, _ in fields if not n.startswith("chart_")]
    return out.select(*plain, F.struct(*[F.col(f"chart_{n}").alias(n) for n in charts]).alias("charts"))


def write_insights(record: DataFrame, path: str) -> None:
    record.coalesce(1).write.mode("overwrite").json(path)


def _as_json() -> Column:
    return F.to_json(F.struct("*"), {"ignoreNullFields": "false"})


def chart_entries(spark: SparkSession, charts: Mapping[str, tuple[DataFrame, Sequence[str | Column]]]) -> DataFrame:
    """chart, position (from 0 in the chart's order), of (its length), entry (the row as JSON).

    A chart is sorted by range over its order, equal places by their JSON, and stored; positions follow from the number of
    rows in each sorted part. A window sees one row per part, so a chart may be of any length.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/charts-{uuid.uuid4().hex}"
    for name, (df, order) in charts.items():
        keys = [(F.col(k) if isinstance(k, str) else k).alias(f"k{i}") for i, k in enumerate(order)]
        rows = nan_safe(df).select(*keys, _as_json().alias("entry")).orderBy(*[f"k{i}" for i in range(len(order))], "entry")
        rows.select(F.monotonically_increasing_id().alias("at"), "entry").write.parquet(f"{path}/chart={name}")
    rows = spark.read.schema("at long, entry string, chart string").parquet(path).withColumn("part", F.shiftright("at", 33))
    parts = rows.groupBy("chart", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    of_chart = Window.partitionBy("chart")
    before = of_chart.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("chart", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(of_chart).alias("of"))
    return rows.join(parts, ["chart", "part"]).select("chart", (F.col("before") + F.col("at") - F.col("first")).alias("position"), "of", "entry")


def write_insights_document(
    kpis: DataFrame, sources: DataFrame, charts: Mapping[str, tuple[DataFrame, Sequence[str | Column]]], tops: Mapping[str, DataFrame], path: str
) -> None:
    """The record of ``insights_record`` without a task that holds a chart.

    ``<path>/entries`` is the committed table of chart entries. ``<path>/document`` holds the lines of one JSON document,
    sorted by range over (section, position): its parts in the order of their names are the document. An empty chart is
    an empty array, an empty top or record null; NaN is null.
    """
    spark = kpis.sparkSession
    versions.write(chart_entries(spark, charts), f"{path}/entries")
    names = list(charts)
    entries = read_insights(spark, path)
    section = F.array_position(F.array(*[F.lit(n) for n in names]).cast("array<string>"), F.col("chart"))
    lines = entries.select(section.alias("section"), "position", F.concat("entry", F.when(F.col("position") + 1 < F.col("of"), ",").otherwise("")).alias("line"))
    heads = {"generated_from": sources, "kpis": kpis, **tops}
    for i, (name, df) in enumerate(heads.items()):
        row = nan_safe(df).agg(F.coalesce(F.first(_as_json()), F.lit("null")).alias("row"))
        lines = lines.unionByName(row.select(F.lit(0).cast("long").alias("section"), F.lit(i).cast("long").alias("position"), F.concat(F.lit(f"{json.dumps(name)}:"), "row", F.lit(",")).alias("line")))
    last = 1 << 62
    frame = [(0, -1, "{"), (0, last, '"charts":{'), (len(names) + 1, 0, "}}")]
    for i, name in enumerate(names, 1):
        frame += [(i, -1, f"{json.dumps(name)}:["), (i, last, "]," if i < len(names) else "]")]
    lines = lines.unionByName(spark.createDataFrame(frame, "section long, position long, line string"))
    lines.orderBy("section", "position").select("line").write.mode("overwrite").text(f"{path}/document")


def read_insights(spark: SparkSession, path: str) -> DataFrame:
    """chart, position, of, entry of a written insights document."""
    return versions.read(spark, f"{path}/entries")


def read_campaign_targets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TARGET_SCHEMA).option("header", True).csv(path)
