"""A landing zone for orders and their lines, laid out for the jobs that read them.

Both tables are bucketed and sorted by order key, with one bucket number, and
partitioned by the order's month.  So the join of orders with their lines moves no
line, and a date range reads its months only, of the lines too, which carry no
date at the source.  Landing is one job per table; the lines are shuffled once, there,
instead of in every extract.

The tables are listed in the session's catalog under names of their own, which is what
lets Spark know the buckets; the files lie under the shared work folder.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.session import work_path
from dimwright.sources.oltp import Oltp


def month_of(day: Column) -> Column:
    """yyyymm as INT."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


class Landed(Oltp):
    """The order database with orders and lines read from the landing zone; everything else as in ``src``."""

    def __init__(self, src: Oltp, orders_table: str, lines_table: str):
        super().__init__(src.spark, src.sf_dir)
        self.src, self.orders_table, self.lines_table = src, orders_table, lines_table

    def __getattribute__(self, name: str):
        if name in ("cities", "state_provinces", "countries", "customers", "customer_categories", "stock_items", "colors",
                    "people"):
            return getattr(self.src, name)
        return super().__getattribute__(name)

    def _within(self, table: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
        rows = self.spark.table(table)
        if start is not None:
            rows = rows.where(F.col("OrderMonth") >= start.year * 100 + start.month)
        if end is not None:
            rows = rows.where(F.col("OrderMonth") <= end.year * 100 + end.month)
        return rows.drop("OrderMonth")

    def orders(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        rows = self._within(self.orders_table, start, end)
        if start is not None:
            rows = rows.where(F.col("OrderDate") >= F.lit(str(start)).cast("date"))
        return rows if end is None else rows.where(F.col("OrderDate") <= F.lit(str(end)).cast("date"))

    @cached_property
    def order_lines(self) -> DataFrame:
        return self._within(self.lines_table, None, None)

    def lines(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        return self._within(self.lines_table, start, end)

    def drop(self) -> None:
        """Take the tables out of the session's catalog (their files stay)."""
        for table in (self.orders_table, self.lines_table):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def land(src: Oltp, buckets: int | None = None) -> Landed:
    """Write the landing zone of ``src``; ``buckets`` is the session's number of shuffle partitions by default.

    Lines of unknown orders go to month 0, so none is lost.
    """
    spark = src.spark
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mark = uuid.uuid4().hex[:12]

    def write(df: DataFrame, name: str) -> str:
        table = f"landing_{name}_{mark}"
        # Dealt by the bucket key beforehand, so a bucket is one file per month.
        (df.repartition(n, "OrderID").write.partitionBy("OrderMonth").bucketBy(n, "OrderID").sortBy("OrderID")
         .option("path", work_path(spark, f"landing-{name}")).saveAsTable(table))
        return table

    orders = src.orders().withColumn("OrderMonth", month_of(F.col("OrderDate")))
    orders_table = write(orders, "orders")
    months = spark.table(orders_table).select("OrderID", "OrderMonth")
    lines = src.order_lines.join(months, "OrderID", "left").withColumn("OrderMonth", F.coalesce("OrderMonth", F.lit(0)))
    return Landed(src, orders_table, write(lines, "lines"))
