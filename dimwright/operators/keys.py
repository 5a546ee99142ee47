"""Dense surrogate keys, assigned in parallel.

``row_number()`` over an unpartitioned window would pull every row into one
task.  Instead rows are range-partitioned and sorted on the (unique) ordering
key, each row gets its position inside its partition, partition sizes are
counted (one small row per partition), and their running sum gives
each partition's offset.  The key equals ``base + row_number() over (order by
keys)`` but no step holds more than one partition's rows.

The ranged data is written to the shared checkpoint folder before counting: range bounds come from sampling, so the counted copy
and the numbered copy must be the same materialisation, also if an executor is
lost and a stage re-runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.session import ensure_checkpoint_dir, work_path

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | position


def with_dense_keys(
    df: DataFrame,
    order_by: list[str],
    key_col: str,
    base: int | DataFrame = 0,
    num_partitions: int | None = None,
    key_type: str = "long",
) -> DataFrame:
    """Add ``key_col`` = base + 1, base + 2, ... in ``order_by`` order.

    ``base`` is an int or a one-row DataFrame with a single column (for example
    ``dim.agg(max(key))``).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # Without an explicit count AQE may coalesce adjacent ranges; partition ids
    # after coalescing are still in key order, which is all the numbering needs.
    ranged_df = df.repartitionByRange(num_partitions, *order_by) if num_partitions else df.repartitionByRange(*order_by)
    ranged = materialize(
        ranged_df
        .sortWithinPartitions(*order_by)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    pid = F.shiftright(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    # One count per partition comes to the driver and goes back as one literal
    # array, so the result is a plain projection of the written copy and its
    # size stays known to the planner.
    sizes = {r["_pid"]: r["_n"] for r in ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).collect()}
    offsets, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        offsets.append(total)
        total += sizes.get(p, 0)
    first = int((base.first()[0] or 0) if isinstance(base, DataFrame) else base)
    off = F.element_at(F.lit(offsets or [0]), (pid + 1).cast("int")).cast("long")
    return ranged.withColumn(key_col, (F.lit(first) + off + pos + 1).cast(key_type)).drop("_mid")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the copy.

    Used for preloads (dimension versions): they are read by several joins and
    their keys must never be recomputed.  A reliable checkpoint survives the
    loss of the executors that computed it.
    """
    spark = df.sparkSession
    path = work_path(spark, "materialized")
    df.write.mode("overwrite").parquet(path)  # one job; eager checkpoint() would run two
    return spark.read.schema(df.schema).parquet(path)


def max_key(dim: DataFrame, key_col: str) -> DataFrame:
    """One-row DataFrame holding the highest key in use (0 when empty)."""
    return dim.agg(F.coalesce(F.max(key_col), F.lit(0)).alias("_max"))
