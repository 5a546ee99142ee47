"""Profiling: column catalogue of tables, value frequencies, blank counts,
duplicate-key counts, min/avg/max summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimwright.functions.semantics import int_avg, is_null_or_blank


def sql_type_name(dtype: T.DataType) -> str:
    """ANSI-style type name of a Spark type (as an information schema shows it)."""
    simple = {
        T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.ShortType: "SMALLINT",
        T.ByteType: "TINYINT", T.DoubleType: "DOUBLE", T.FloatType: "FLOAT",
        T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN", T.DateType: "DATE",
        T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE",
        T.BinaryType: "BLOB",
    }
    for cls, name in simple.items():
        if isinstance(dtype, cls):
            return name
    if isinstance(dtype, T.ArrayType):
        return f"{sql_type_name(dtype.elementType)}[]"
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    return dtype.simpleString().upper()


def profile_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(TABLE_NAME, COLUMN_NAME, ORDINAL_POSITION, DATA_TYPE, TABLE_ROWS): one row per column, with the row count of its table.

    Names and types come from the schema, the count from the table.
    """
    parts = []
    for name, df in tables.items():
        fields = [F.struct(F.lit(f.name).alias("c"), F.lit(i).alias("p"), F.lit(sql_type_name(f.dataType)).alias("t"))
                  for i, f in enumerate(df.schema.fields, 1)]
        counted = df.agg(F.count(F.lit(1)).alias("TABLE_ROWS"))
        parts.append(counted.select("TABLE_ROWS", F.explode(F.array(*fields)).alias("f")).select(
            F.lit(name).alias("TABLE_NAME"), F.col("f.c").alias("COLUMN_NAME"),
            F.col("f.p").alias("ORDINAL_POSITION"), F.col("f.t").alias("DATA_TYPE"), "TABLE_ROWS"))
    return reduce(DataFrame.unionByName, parts)


def profile_catalog(spark: SparkSession) -> DataFrame:
    """``profile_columns`` of every table and view that the session's catalog lists, in its current database."""
    names = sorted(t.name for t in spark.catalog.listTables())
    if not names:
        raise ValueError("the session's catalog lists no table")
    return profile_columns(spark, {name: spark.table(f"`{name}`") for name in names})


def value_counts(df: DataFrame, column: str, alias: str = "N") -> DataFrame:
    """``SELECT c, COUNT(c) GROUP BY c`` - the null group reports 0."""
    return df.groupBy(column).agg(F.count(F.col(column)).alias(alias))


def blank_counts(df: DataFrame, column: str, alias: str = "N") -> DataFrame:
    """Frequency of null or blank values (the null group counts 0)."""
    return value_counts(df.filter(is_null_or_blank(column)), column, alias)


def dup_key_counts(df: DataFrame, key: str, alias: str = "N") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.col(key)).alias(alias))


def int_stats(df: DataFrame, column: str, prefix: str, group: list[str] | None = None) -> DataFrame:
    """MIN / truncated integer AVG / MAX of ``CAST(column AS INT)``."""
    d = df.withColumn("_v", F.col(column).cast("int"))
    aggs = [
        F.min("_v").alias(f"MIN_{prefix}"),
        int_avg("_v").alias(f"AVG_{prefix}"),
        F.max("_v").alias(f"MAX_{prefix}"),
    ]
    return d.groupBy(*group).agg(*aggs) if group else d.agg(*aggs)
