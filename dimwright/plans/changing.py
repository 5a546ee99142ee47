"""A source whose members change between runs, and a mart loaded from it.

The order dates are cut into three periods of equal length; each is loaded by one
run with the source as it is in that period:

    customers   ids ending 1 mod 5 change category in period 1, ids 2 mod 5 in
                period 2; ids 0 mod 5 are spelled in capitals with a trailing
                blank from period 1 on (no change); ids 3 mod 7 are gone in period 2
    products    ids 1 mod 4 change brand in period 1
    cities      every country gets another formal name in period 2 (type 1: the
                newest value holds for all orders)
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.operators.load import Mart
from dimwright.plans import mart as M
from dimwright.sources.oltp import Oltp


class ChangingOltp(Oltp):
    """The order database as it is in one period (0, 1 or 2)."""

    def __init__(self, spark: SparkSession, sf_dir: str, period: int):
        super().__init__(spark, sf_dir)
        self.period = period

    @cached_property
    def customers(self) -> DataFrame:
        c = super().customers
        group, category, name = F.col("CustomerID") % 5, F.col("CustomerCategoryID"), F.col("CustomerName")
        if self.period >= 1:
            name = F.when(group == 0, F.concat(F.upper(name), F.lit(" "))).otherwise(name)
            category = F.when(group == 1, F.concat(category, F.lit(" v1"))).otherwise(category)
        if self.period >= 2:
            category = F.when(group == 2, F.concat(category, F.lit(" v2"))).otherwise(category)
            c = c.filter(F.col("CustomerID") % 7 != 3)
        return c.withColumns({"CustomerName": name, "CustomerCategoryID": category})

    @cached_property
    def customer_categories(self) -> DataFrame:
        return self.customers.select("CustomerCategoryID").distinct().withColumn(
            "CustomerCategoryName", F.col("CustomerCategoryID"))

    @cached_property
    def stock_items(self) -> DataFrame:
        changed = (F.col("StockItemID") % 4 == 1) & F.lit(self.period >= 1)
        return super().stock_items.withColumn(
            "Brand", F.when(changed, F.concat(F.col("Brand"), F.lit(" v1"))).otherwise(F.col("Brand")))

    @cached_property
    def countries(self) -> DataFrame:
        suffix = " r2" if self.period >= 2 else ""
        return super().countries.withColumn("FormalName", F.concat(F.col("FormalName"), F.lit(suffix)))


def periods(first: dt.date, last: dt.date) -> list[tuple[dt.date, dt.date]]:
    """Three date ranges of equal length (the last takes the remainder)."""
    third = ((last - first).days) // 3
    starts = [first, first + dt.timedelta(days=third), first + dt.timedelta(days=2 * third)]
    return [(starts[0], starts[1] - dt.timedelta(days=1)), (starts[1], starts[2] - dt.timedelta(days=1)),
            (starts[2], last)]


def run_periods(spark: SparkSession, sf_dir: str, mart: Mart | None = None) -> Mart:
    """Load the three periods in turn."""
    mart = mart or Mart(spark)
    bounds = M.order_date_bounds(Oltp(spark, sf_dir))
    for period, (start, end) in enumerate(periods(*bounds)):
        M.run_dates(ChangingOltp(spark, sf_dir, period), mart, start, end)
    return mart


def sales(mart: Mart) -> DataFrame:
    """Lines and revenue per year, category and brand at the time of the order, and today's formal country name."""
    return M.sales_by_member(mart.read_fact(), mart.read(M.CUSTOMERS.name), mart.read(M.PRODUCTS.name),
                             mart.read(M.CITIES.name))
