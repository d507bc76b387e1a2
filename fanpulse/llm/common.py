"""Helpers shared by the training-data operators: shared scratch tables, bounded text slices, constants."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes that are white space in the word rule ``[^\x20\x09-\x0D]+``; ``bytes.split()`` splits at the same six.
SPACES = " \t\n\x0b\x0c\r"

#: Of an Arrow batch between Spark and a Python worker; Spark's own bound is 10,000 rows, whatever their texts' length.
BATCH_BYTES = "2m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; one of our own only where it is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="fanpulse-llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder once and read it back.

    Spark's commit protocol makes the table whole whatever executors are lost; later jobs read files, not shuffles.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freed(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Delete tables of ``stored()``, or scratch folders, that nothing reads any more: what was computed from them is stored itself."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    for t in tables:
        folders = {t} if isinstance(t, str) else {unquote(f.rpartition("/")[0]) for f in t.inputFiles()}
        for folder in folders:
            if not re.search(r"/llm-[a-z]+-[0-9a-f]{32}(/|$)", folder):
                raise ValueError(f"{folder} is no scratch folder")
            path = hadoop.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def entered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns as own_0, own_1, ...: an operator's own column names then clash with none of them."""
    return docs.toDF(*[f"own_{i}" for i in range(len(docs.columns))])


def own(docs: DataFrame, name: str) -> str:
    """The name that column ``name`` of ``docs`` has in ``entered(docs)``."""
    return f"own_{docs.columns.index(name)}"


def restored(df: DataFrame, docs: DataFrame, *more: str) -> DataFrame:
    """The columns of ``docs`` under their names again, then ``more`` columns of ``df``, which replace those of their names."""
    back = [F.col(f"own_{i}").alias(c) for i, c in enumerate(docs.columns) if c not in more]
    return df.select(*back, *more)


def numbered(df: DataFrame, by: list[str], order: list[str], name: str = "pos", total: str = "of") -> DataFrame:
    """``df`` with ``name``, the place of a row among those of equal ``by`` in ``order`` (from 0), and ``total``, their number.

    Rows are sorted by range over (by, order), so a key that holds a third of all rows is spread over many partitions;
    places follow from the partitions' counts. A window sees one row per partition and key, never the rows themselves.
    Nulls come first and are a key of their own.
    """
    keys = [*by, *order]
    rows = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("nr_at", F.monotonically_increasing_id()), "sorted")
    rows = rows.withColumn("nr_part", F.shiftright("nr_at", 33))  # the id's upper bits are the partition's number
    parts = rows.groupBy("nr_part", *by).agg(F.min("nr_at").alias("nr_first"), F.count("*").alias("nr_n"))
    of_key = Window.partitionBy(*by)
    before = of_key.orderBy("nr_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("nr_part").alias("nr_p"), *[F.col(c).alias(f"nr_by{i}") for i, c in enumerate(by)], "nr_first",
        F.coalesce(F.sum("nr_n").over(before), F.lit(0)).alias("nr_before"), F.sum("nr_n").over(of_key).alias("nr_of"))
    same = [F.col("nr_part") == F.col("nr_p"), *[F.col(c).eqNullSafe(F.col(f"nr_by{i}")) for i, c in enumerate(by)]]
    rows = rows.join(parts, same)
    return rows.select(*df.columns, (F.col("nr_before") + F.col("nr_at") - F.col("nr_first")).alias(name), F.col("nr_of").alias(total))


def bounded_batches(spark: SparkSession) -> None:
    """From now on Arrow batches end at ``BATCH_BYTES`` too, unless the session has a bound of its own: both sides hold them outside the heap."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def text_slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to few rows, so that what a task holds besides a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
