"""Sharding by a Hilbert curve over several metadata dimensions (DataFrame operations only).

Each dimension is quantised to ``2**bits`` cells by approximate quantiles of the whole table, texts by the share of rows
before each whole value (both order-preserving, so a run of cells is a range of values), the cells' Hilbert index is computed
in an expression, rows are sorted by (index, text checksum, text hash, id) and the sorted sequence is cut into runs. Files
of a run then cover a small box of the metadata space and min/max statistics prune on any of the dimensions. Rows of equal
texts take the index of the group's least source and language, so they stand side by side and are parted by a run's end only.

Law ``rows`` cuts runs whose counts are at most one apart, ``bytes`` runs of near equal size (a row belongs to the run
that holds its middle byte). Nulls in a dimension take the lowest cell; a null text has size 0 + 8 and the checksum of
the empty text. Long texts count by their bytes. Ties and repeated rows each take a slot of their own. Columns that are not named pass through, whatever
their names, unless they clash with a result column, which then replaces them. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import entered, numbered, own, restored, stored, table

INDEX_BITS = 33  # monotonically_increasing_id(): the row's number in its partition


def hilbert_table(dims: int) -> tuple[list[int], list[int]]:
    """(next state, digit) at ``state * 2**dims + cell``; a state is an entry corner and a direction."""
    n, mask = dims, (1 << dims) - 1
    gray = lambda i: i ^ (i >> 1)
    rot = lambda x, k: ((x << (k % n)) | (x >> (n - k % n))) & mask
    ones = lambda i: (~i & (i + 1)).bit_length() - 1  # trailing ones
    ungray = {gray(i): i for i in range(1 << n)}
    step, digit = [], []
    for state in range(n << n):
        e, d = divmod(state, n)
        for cell in range(1 << n):
            w = ungray[rot(cell ^ e, n - (d + 1) % n)]
            e2 = e ^ rot(0 if w == 0 else gray(2 * ((w - 1) // 2)), d + 1)
            d2 = (d + (0 if w == 0 else ones(w - 1) if w % 2 == 0 else ones(w)) + 1) % n
            step.append(e2 * n + d2)
            digit.append(w)
    return step, digit


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Index of the cell on the curve through ``2**bits`` cells in each dimension."""
    n = len(cells)
    step, digit = hilbert_table(n)
    steps, digits = F.array(*map(F.lit, step)), F.array(*map(F.lit, digit))

    def level(acc: Column, i: Column) -> Column:
        at = acc["state"] * (1 << n) + reduce(lambda a, b: a + b, [(F.call_function("shiftright", c, i).bitwiseAND(F.lit(1))) * (1 << k) for k, c in enumerate(cells)])
        return F.struct(F.get(steps, at).alias("state"), (acc["h"] * (1 << n) + F.get(digits, at).cast("long")).alias("h"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("h"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, level)["h"]


def number_cell(number: Column, cuts: list[float] | None) -> Column:
    """How many of the cuts lie below; nulls and columns without any value take cell 0."""
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts)))), lambda c: c < number)), F.lit(0)) if cuts else F.lit(0)


def text_cells(df: DataFrame, name: str, bits: int) -> DataFrame:
    """value, cell: every value of a text column, cut by the share of rows before it, so values with a common beginning fall
    apart. One row per distinct value; nulls have no row."""
    values = numbered(df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n")), [], ["value"], "place", "of")
    values = stored(values, "values")
    # rows before a value: from the sums of runs of values, then inside the run
    run = F.expr("place div 4096")
    of_run = values.groupBy(run.alias("run")).agg(F.sum("n").alias("in_run"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # a row per 4096 values
    of_run = of_run.select(F.col("run").alias("r"), F.coalesce(F.sum("in_run").over(before), F.lit(0)).alias("ahead"), F.sum("in_run").over(Window.partitionBy()).alias("all_rows"))
    inside = Window.partitionBy("run").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = values.withColumn("run", run).withColumn("own_before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(of_run, F.col("run") == F.col("r"))
    return rows.select("value", F.expr(f"cast((ahead + own_before) * {1 << bits} div all_rows as int)").alias("cell"))


def assign(df: DataFrame, dims: list[str], shards: int = 24, law: str = "rows", size_col: str = "size", ties: tuple[str, ...] = (), bits: int = 5) -> DataFrame:
    """``df`` with ``hilbert``, ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law {law}")
    df = df.drop("hilbert", "shard", "slot")
    types = dict(df.dtypes)
    number = {d: F.col(d).cast("double") for d in dims if types[d] != "string"}
    shares = F.array(*[F.lit(k / (1 << bits)) for k in range(1, 1 << bits)])
    cuts = df.agg(*[F.percentile_approx(n, shares, 2000).alias(d) for d, n in number.items()]).first() if number else {}
    rows, cells = df, []
    for i, d in enumerate(dims):
        if d in number:
            cells.append(number_cell(number[d], cuts[d]))
        else:
            values = stored(text_cells(df, d, bits), "cells").select(F.col("value").alias(f"value_{i}"), F.col("cell").alias(f"cell_{i}"))
            rows = rows.join(values, F.col(d) == F.col(f"value_{i}"), "left")  # broadcast or split by size, as Spark finds it
            cells.append(F.coalesce(F.col(f"cell_{i}"), F.lit(0)))
    keys = ["hilbert", *ties]
    rows = rows.withColumn("hilbert", hilbert_index(cells, bits)).select(*df.columns, "hilbert")
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    rows = stored(rows, "hilbert")  # fixes partitions and places: everything below counts on them
    part, at = F.shiftright(F.col("__at"), INDEX_BITS), F.col("__at").bitwiseAND(F.lit((1 << INDEX_BITS) - 1))
    parts = rows.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"), F.sum(F.col(size_col)).alias("__bytes"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition of the sort
    whole = Window.partitionBy()
    parts = parts.select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"), F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__b0"),
        F.sum("__n").over(whole).alias("__rows"), F.sum("__bytes").over(whole).alias("__total"),
    )
    rows = rows.withColumn("__part", part).join(parts, "__part").withColumn("__rank", F.col("__n0") + at)
    if law == "rows":
        rows = rows.withColumn("shard", F.expr(f"cast(__rank * {shards} div __rows as int)"))
        rows = rows.withColumn("slot", F.col("__rank") - F.expr(f"(shard * __rows + {shards - 1}) div {shards}"))
    else:
        inside = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("__middle", F.col("__b0") + F.sum(size_col).over(inside) - F.expr(f"({size_col} + 1) div 2"))
        rows = rows.withColumn("shard", F.expr(f"cast(least(__middle * {shards} div __total, {shards - 1}) as int)"))
        first = rows.groupBy("shard").agg(F.min("__rank").alias("__first"))
        rows = rows.join(first, "shard").withColumn("slot", F.col("__rank") - F.col("__first"))
    return rows.select(*df.columns, "hilbert", "shard", "slot")


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def crc_of(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def together(rows: DataFrame, key: str, dims: list[str]) -> DataFrame:
    """``rows`` whose ``dims`` are the least ones among the rows of equal ``key``: a group gets one place on the curve."""
    least = stored(rows.groupBy(F.col(key).alias("g_key")).agg(F.count("*").alias("g_n"), *[F.min(d).alias(f"g_{d}") for d in dims]).where("g_n > 1"), "groups")
    out = rows.join(least, F.col(key) == F.col("g_key"), "left")
    return out.select(*[(F.when(F.col("g_n").isNull(), F.col(c)).otherwise(F.col(f"g_{c}")).alias(c) if c in dims else F.col(c)) for c in rows.columns])


def shard_documents(docs: DataFrame, shards: int = 24, law: str = "rows", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` (texts too) with ``shard`` and ``slot``, over source, language and size; equal texts side by side."""
    text = F.col(own(docs, text_col))
    rows = entered(docs).withColumns({"size": size_of(text), "crc": crc_of(text), "key": F.xxhash64(F.coalesce(text, F.lit(""))),
                                      "source": F.col(own(docs, "source")), "lang": F.col(own(docs, "lang"))})
    out = assign(together(rows, "key", ["source", "lang"]), ["source", "lang", "size"], shards, law, "size", ("crc", "key", own(docs, id_col)))
    return restored(out, docs, "shard", "slot")


def write_shards(sharded: DataFrame, path: str, shards: int = 24) -> None:
    """One folder per shard, rows in slot order inside each file."""
    sharded.repartitionByRange(4 * shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", size_of(text).alias("size"), crc_of(text).alias("text_crc32"), "source", "lang", F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"))
    rows = together(stored(rows, "sizes"), "key", ["source", "lang"])
    out = assign(rows, ["source", "lang", "size"], 24, "rows", "size", ("text_crc32", "key", "doc_id"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")
