"""Join helpers: first-row-per-key picks and the disjunctive (OR) equi-join rewrite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], cols: list[str]) -> DataFrame:
    """One row per key: the smallest ``order`` tuple, carrying ``cols``.

    Written as ``min(struct(order..., cols...))``, which Spark aggregates partially
    before the shuffle (by sorting, as a struct has no fixed-size buffer), so a
    hot key sends one row per task. Each order term must
    already encode null placement, e.g. ``(x.isNull(), x)`` for nulls last.
    """
    order_fields = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    packed = F.min(F.struct(*order_fields, *[F.col(c) for c in cols])).alias("_best")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in cols])


def asc_nulls_last(c: Column) -> list[Column]:
    """Order terms for ``c asc nulls last`` inside :func:`first_per_key`."""
    return [c.isNull(), c]


def or_equi_join(left: DataFrame, left_keys: list[Column], right: DataFrame, right_key: str, how: str = "inner") -> DataFrame:
    """``left JOIN right ON k1 = r OR k2 = r`` as explode + equi-join + distinct.

    The literal OR plans as a nested-loop join; this rewrite keeps a hash join.
    ``distinct`` removes the duplicate when several keys hit the same right row.
    """
    exploded = left.withColumn("_or_key", F.explode(F.array_distinct(F.array(*left_keys)))).filter(F.col("_or_key").isNotNull())
    joined = exploded.join(right, exploded["_or_key"] == right[right_key], how).drop("_or_key")
    return joined.distinct()
