"""Calendar dimension (one row per date, ISO week, Monday = 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanpulse.functions.scalar import calendar_columns


def date_dimension(span: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Expand each (lo, hi) row of ``span`` into its dates with calendar attributes.

    ``span`` is normally a one-row aggregate (min/max of the facts), so the
    output grows with the covered period, not with the data volume.
    """
    days = span.select(F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select("date", *[c.alias(n) for n, c in calendar_columns("date").items()])
