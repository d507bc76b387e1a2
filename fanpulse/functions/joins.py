"""Join and dedupe helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class CardinalityError(ValueError):
    pass


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once (partial aggregation, skew-safe)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def join_validated(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    validate: str = "many_to_one",
) -> DataFrame:
    """Join after checking the declared cardinality; raise like pandas ``validate``.

    The check is one aggregate over the "one" side(s) and only a single
    offending key ever reaches the driver.
    """
    keys = [on] if isinstance(on, str) else list(on)
    sides = {
        "many_to_one": [("right", right)],
        "one_to_many": [("left", left)],
        "one_to_one": [("left", left), ("right", right)],
        "many_to_many": [],
    }
    if validate not in sides:
        raise ValueError(f"unknown validate mode {validate!r}")
    for side_name, side in sides[validate]:
        bad = duplicate_keys(side.select(*keys), keys).limit(1).collect()
        if bad:
            raise CardinalityError(
                f"merge keys are not unique in {side_name} dataset ({validate}): {bad[0].asDict()}"
            )
    return left.join(right, on=keys, how=how)


def unique_by(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``df``, whose job fails if a key occurs twice: the guard of a merge's "one" side, inside the plan.

    One aggregate with map-side combine; no job runs while the plan is built. Pass only the columns that are needed."""
    others = [c for c in df.columns if c not in keys]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(0).alias("_"), *others)).alias("_row"))
    message = F.concat(F.lit(f"merge keys are not unique in {name}: "), F.to_json(F.struct(*keys)))
    per_key = per_key.where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return per_key.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def left_join_spread(left: DataFrame, right: DataFrame, key: str, spread: Sequence[str]) -> DataFrame:
    """Left join on a string ``key`` whose left rows without a key are dealt over the partitions by ``spread``.

    They match nothing, but a plain join by key sends all of them to one task. Here a row joins by "=" and its key or, if
    that is NULL, by "0" and a hash, which equals no key of the right side. Rows are those of the plain join."""
    dealt = F.concat(F.lit("0"), F.pmod(F.xxhash64(*spread), F.lit(1 << 20)).cast("string"))
    rows = left.withColumn("_at", F.coalesce(F.concat(F.lit("="), F.col(key)), dealt))
    found = right.select(F.concat(F.lit("="), F.col(key)).alias("_at"), *[c for c in right.columns if c != key])
    return rows.join(found, "_at", "left").drop("_at")


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per key under an explicit order (no reliance on file order).

    Implemented as an aggregate (min_by over the ordering struct) so that
    partial aggregation bounds the work for a hot key.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    others = [c for c in df.columns if c not in keys]
    ordered = F.struct(*[oc.alias(f"_o{i}") for i, oc in enumerate(order_cols)])
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in others]), ordered).alias("_row")
    )
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)
