"""Tables in buckets of a key, for joins and aggregates on it without an exchange."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

TARGET_BYTES = 256 << 20


def buckets_for(spark: SparkSession, total_bytes: int, target_bytes: int = TARGET_BYTES) -> int:
    """Buckets of about ``target_bytes``, at least one per shuffle partition the session asks for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total_bytes // target_bytes))


def stored(spark: SparkSession, path: str, tables: Mapping[str, DataFrame], key: str, buckets: int | None = None, total_bytes: int = 0) -> list[DataFrame]:
    """Write every table in the same number of buckets by ``key``, sorted by it inside, and return them as tables.

    Rows are dealt to the buckets by one exchange before the write, so a task writes one file per bucket it holds. The data
    lie below ``path``; the catalog entries have names of their own. A key's rows share a bucket, as they share a task in
    a join: a key that holds a large share of all rows should be left to joins that AQE can split.
    """
    count, out = buckets or buckets_for(spark, total_bytes), []
    for name, df in tables.items():
        entry = f"bucketed_{name}_{uuid.uuid4().hex}"
        df.repartition(count, key).write.bucketBy(count, key).sortBy(key).option("path", f"{path}/{name}").saveAsTable(entry)
        out.append(spark.table(entry))
    return out
