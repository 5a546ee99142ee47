"""Data-quality checks standing in for PRIMARY KEY, FOREIGN KEY and NOT NULL.

Each is a single distributed aggregate or anti join that returns the offending
rows (empty result = constraint holds), so the checks scale with the table and
nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count ``N``."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("N"))
        .filter(F.col("N") > 1)
    )


def orphan_keys(fact: DataFrame, references: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fact foreign-key values without a dimension row, from one scan of the fact.

    ``references`` maps fact column -> (dimension, dimension key column).
    Result: (KEY_NAME, KEY_VALUE, N) - one row per missing value per key.
    """
    pairs = ", ".join(f"'{fk}', cast(`{fk}` as bigint)" for fk in references)
    values = fact.selectExpr(f"stack({len(references)}, {pairs}) as (KEY_NAME, KEY_VALUE)")
    # Counted before the anti join (map-side partial aggregation): a hot value,
    # such as the unknown member -1, is one row per task when it shuffles.
    counted = values.groupBy("KEY_NAME", "KEY_VALUE").agg(F.count(F.lit(1)).alias("N"))
    known = reduce(DataFrame.unionByName, [
        dim.select(F.lit(fk).alias("KEY_NAME"), F.col(dim_key).cast("long").alias("KEY_VALUE"))
        for fk, (dim, dim_key) in references.items()
    ])
    return counted.join(known, ["KEY_NAME", "KEY_VALUE"], "left_anti")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(COLUMN_NAME, NULL_COUNT) for every column, from one aggregate pass."""
    cols = columns or df.columns
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (COLUMN_NAME, NULL_COUNT)")


def required_nulls(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(TABLE_NAME, COLUMN_NAME, NULL_COUNT) of the columns that must not be null, one aggregate per table."""
    return reduce(DataFrame.unionByName, [
        null_counts(df, columns).select(F.lit(name).alias("TABLE_NAME"), "COLUMN_NAME", "NULL_COUNT")
        for name, (df, columns) in tables.items()
    ])
