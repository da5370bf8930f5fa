"""Ranks and quantiles by value ranges.

A value's range is a step on a logarithmic scale: the same in every task,
ascending with the value, and known without looking at the other values. Rows
are counted by range (partially aggregated, so one huge group never gathers),
and running totals over the few ranges of a group say how many values lie
below or above each. Only the order inside a range is then left to find, in
as many tasks as there are ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def range_of(value: Column, fineness: int) -> Column:
    """Which range a number lies in: ``fineness`` ranges for each factor of e; never falls as the number rises; null stays null."""
    v = value.cast("double")
    step = F.floor(F.log1p(F.abs(v)) * F.lit(float(fineness)))
    return F.when(F.isnan(v), F.lit(1 << 40)).otherwise((F.signum(v) * step).cast("bigint"))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null equals null (``<=>``), keeping the left key columns."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def exact_quantile(df: DataFrame, keys: list[str], value: str, out: str, q: float = 0.5, accuracy: int = 1000,
                   weight: str | None = None) -> DataFrame:
    """Exact quantile (linear interpolation, nulls skipped) per group, from two reads of ``df``.

    The first read counts each group's values by range (``accuracy`` ranges for
    each factor of e), which says in which one or two ranges the quantile's
    neighbours lie and how many values are below. The second read keeps the
    values of those ranges only and counts equal ones. ``weight`` names a column
    of counts, where a row stands for so many equal values; histograms of this
    form add up, so those of months give those of quarters. A group without a
    value has no row.
    """
    vals = df.filter(F.col(value).isNotNull()).select(
        *keys, value, (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_c"), range_of(F.col(value), accuracy).alias("_range"))
    hist = vals.groupBy(*keys, "_range").agg(F.sum("_c").alias("_in"))
    group = Window.partitionBy(*keys)
    below = F.sum("_in").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    placed = hist.select(*keys, "_range", "_in", F.sum("_in").over(group).alias("_n"), F.coalesce(below, F.lit(0)).alias("_below"))
    at = (F.col("_n") - 1) * F.lit(q)
    first, last = F.floor(at), F.ceil(at)
    held = lambda r: (F.col("_below") <= r) & (r < F.col("_below") + F.col("_in"))
    targets = placed.filter(held(first) | held(last)).select(*keys, "_range", "_below", "_n")
    inside = join_null_safe(vals, targets, [*keys, "_range"]).groupBy(*keys, "_range", value, "_below", "_n").agg(F.sum("_c").alias("_c"))

    run = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_below") + F.sum("_c").over(run)
    ranked = inside.select(*keys, F.col(value).cast("double").alias("_v"), "_c", "_n", upto.alias("_upto"))
    is_at = lambda r: (F.col("_upto") - F.col("_c") <= r) & (r < F.col("_upto"))
    found = ranked.groupBy(*keys).agg(F.max(F.when(is_at(first), F.col("_v"))).alias("_low"), F.max(F.when(is_at(last), F.col("_v"))).alias("_high"),
                                      F.max(at - first).alias("_share"))
    return found.select(*keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias(out))


def ranks_desc(df: DataFrame, key: str, ranks: dict[str, str], fineness: int = 64) -> DataFrame:
    """``key`` and, for each column named in ``ranks`` (column -> name of its rank), its rank in descending order, nulls last.

    Equal values share a rank and leave a gap, as SQL's ``rank()`` does. Distinct
    values are counted and ranked, so that ties never gather in one task;
    numbers of any type are told apart exactly.
    """
    entries = [F.struct(F.lit(c).alias("_metric"), F.col(c).cast("double").alias("_v"),
                        (F.col(c).cast("decimal(38,2)") if str(df.schema[c].dataType.typeName()) == "decimal" else F.lit(None).cast("decimal(38,2)")).alias("_d"))
               for c in ranks]
    long = df.select(key, F.explode(F.array(*entries)).alias("_e")).select(key, "_e.*")
    lowest = F.lit(-(1 << 41))  # the range of null
    counts = long.groupBy("_metric", "_v", "_d").agg(F.count(F.lit(1)).alias("_c")) \
        .withColumn("_range", F.coalesce(range_of(F.col("_v"), fineness), lowest))
    hist = counts.groupBy("_metric", "_range").agg(F.sum("_c").alias("_in"))
    above = Window.partitionBy("_metric").orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = hist.select("_metric", "_range", F.coalesce(F.sum("_in").over(above), F.lit(0)).alias("_above"))
    run = Window.partitionBy("_metric", "_range").orderBy(F.col("_v").desc_nulls_last(), F.col("_d").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.join(offsets, ["_metric", "_range"]).select(
        "_metric", "_v", "_d", (F.col("_above") + F.coalesce(F.sum("_c").over(run), F.lit(0)) + 1).cast("bigint").alias("_rank"))
    named = join_null_safe(long, ranked, ["_metric", "_v", "_d"])
    return named.groupBy(key).agg(*[F.max(F.when(F.col("_metric") == c, F.col("_rank"))).alias(name) for c, name in ranks.items()])
