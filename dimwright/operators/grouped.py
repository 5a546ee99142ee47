"""Grouped analytics: counts, running totals, arg-max/min groups, shares.

Grand totals and extremes are one-row aggregates joined back (broadcast: one
row by construction), never ``OVER ()`` windows, which would move every row
into a single task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimwright.functions.semantics import percentage
from dimwright.operators.joins import single_row_broadcast
from dimwright.operators.keys import materialize


def group_count(df: DataFrame, keys: list[str], counted: str | Column, alias: str) -> DataFrame:
    """``SELECT keys, COUNT(counted) alias GROUP BY keys`` (nulls not counted)."""
    c = F.col(counted) if isinstance(counted, str) else counted
    return df.groupBy(*keys).agg(F.count(c).alias(alias))


def running_total(
    counts: DataFrame, partition_by: list[str], order_by: list[Column], value: str, alias: str
) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY ... ORDER BY ...)`` with the default
    RANGE frame: peers (equal order values) share the same running total."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return counts.withColumn(alias, F.sum(value).over(w).cast("long"))


def running_total_blocks(
    df: DataFrame, partition_by: list[str], order_by: list[tuple[str, bool]], value: str, alias: str,
    blocks: int | None = None,
) -> DataFrame:
    """``running_total`` as a distributed prefix sum: no task holds more than one block of a partition.

    ``order_by`` lists (column, ascending).  Peers are summed first (map-side), so they share
    one place and cannot cross a block border.  Their sums are cut into range
    blocks by partition and order; totals run inside each block, and a block's part of
    a partition that began in earlier blocks adds their sum.  At most one partition
    crosses each border, so the offsets have fewer rows than there are blocks and
    are broadcast.  Rows then take the total of their peers.  Null partition and order
    values are values like any other; null amounts do not count.
    """
    keys = [*partition_by, *[c for c, _ in order_by]]
    order = [F.col(c).asc() if up else F.col(c).desc() for c, up in order_by]
    places = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    by = [F.col(c).asc() for c in partition_by] + order
    ranged = places.repartitionByRange(blocks, *by) if blocks else places.repartitionByRange(*by)
    # Range borders are sampled, so both reads below must see the same copy.
    ranged = materialize(ranged.withColumn("_block", F.spark_partition_id()))
    parts = ranged.groupBy(*partition_by, "_block").agg(F.sum("_sum").alias("_part"))
    earlier = Window.partitionBy(*partition_by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_offset", F.sum("_part").over(earlier)).where("_offset is not null").select(
        *[F.col(c).alias(f"_o_{c}") for c in partition_by], F.col("_block").alias("_o_block"), "_offset")
    within = Window.partitionBy(*partition_by, "_block").orderBy(*order)
    inside = ranged.withColumn("_inside", F.sum("_sum").over(within))
    same = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in partition_by]
    on = reduce(lambda a, b: a & b, same, F.col("_block") == F.col("_o_block"))
    zero = F.lit(0).cast("long")
    totals = inside.join(F.broadcast(offsets), on, "left").select(
        *[F.col(c).alias(f"_k_{c}") for c in keys],
        (F.coalesce("_inside", F.when(F.col("_offset").isNotNull(), zero)) + F.coalesce("_offset", zero))
        .cast("long").alias(alias))
    peers = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys])
    return df.join(totals, peers).drop(*[f"_k_{c}" for c in keys])


def _extreme_groups(counts: DataFrame, value: str, fn) -> DataFrame:
    best = counts.agg(fn(value).alias("_best"))
    return counts.join(single_row_broadcast(best), F.col(value) == F.col("_best")).drop("_best")


def argmax_groups(counts: DataFrame, value: str) -> DataFrame:
    """Groups whose ``value`` equals the maximum; ties are all kept."""
    return _extreme_groups(counts, value, F.max)


def argmin_groups(counts: DataFrame, value: str) -> DataFrame:
    """Groups whose ``value`` equals the minimum; ties are all kept."""
    return _extreme_groups(counts, value, F.min)


def share_of_total(df: DataFrame, group: str, counted: Column, count_alias: str, pct_alias: str) -> DataFrame:
    """Count per group and its percentage of the grand total.

    The grand total counts every row (also a null group), while the null group
    itself is not reported (it would not survive an equality join to a view).
    """
    per = df.groupBy(group).agg(F.count(counted).alias(count_alias)).filter(F.col(group).isNotNull())
    total = df.agg(F.count(counted).alias("_total"))
    return per.crossJoin(single_row_broadcast(total)).select(
        group, count_alias, percentage(F.col(count_alias), F.col("_total")).alias(pct_alias)
    )


def share_within_group(
    df: DataFrame, group: str, flag: Column, counted: Column, count_alias: str, pct_alias: str
) -> DataFrame:
    """Per group: rows meeting ``flag`` and their percentage of the group's rows,
    in one aggregate; groups with no such row, and the null group, are dropped."""
    agg = df.groupBy(group).agg(
        F.count(F.when(flag, counted)).alias(count_alias),
        F.count(counted).alias("_group_total"),
    )
    return agg.filter((F.col(count_alias) > 0) & F.col(group).isNotNull()).select(
        group, count_alias, percentage(F.col(count_alias), F.col("_group_total")).alias(pct_alias)
    )
