"""Histories over the driver tables: a change log of customers, and a day of members that arrives late."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.operators import digests, scd_history
from dimwright.operators.keys import materialize
from dimwright.operators.load import Mart
from dimwright.plans import changing
from dimwright.plans import mart as M
from dimwright.sources.oltp import Oltp

LOG_TRACKED = ["Category", "Tier"]


def _day(d: dt.date) -> F.Column:
    return F.lit(str(d)).cast("date")


def customer_log(src: Oltp) -> DataFrame:
    """One row per order: the customer's category and tier from that day on, or (every seventh order) that it is gone."""
    names = src.customers.select("CustomerID", "CustomerName")
    return src.orders().join(names, "CustomerID").select(
        "CustomerName",
        F.concat(F.lit("C"), (F.col("OrderID") % 3).cast("string")).alias("Category"),
        F.concat(F.lit("T"), (F.floor(F.col("OrderID") / 8) % 2).cast("string")).alias("Tier"),
        F.col("OrderDate").alias("LogDate"), (F.col("OrderID") % 7 == 0).alias("Gone"))


def customers_before_log(src: Oltp, d0: dt.date) -> DataFrame:
    """Two thirds of the customers, open since ten days before the first order; some with an older, closed version."""
    c = src.customers.select(F.col("CustomerID").cast("long").alias("id"), "CustomerName")
    row = lambda key, category, start, end: (
        key.alias("CustomerKey"), "CustomerName", F.lit(category).alias("Category"), F.lit("T0").alias("Tier"),
        _day(d0 - dt.timedelta(days=start)).alias("StartDate"), end.alias("EndDate"))
    current = c.where("id % 3 <> 0").select(*row(F.col("id"), "C0", 10, F.lit(None).cast("date")))
    closed = c.where("id % 5 = 1").select(
        *row(F.col("id") + 1_000_000_000, "C1", 20, _day(d0 - dt.timedelta(days=11))))
    return current.unionByName(closed)


def change_log_history(src: Oltp) -> DataFrame:
    """All versions of the customers after every day of the log, in one pass."""
    d0 = M.first_order_date(src)
    return scd_history.scd2_change_log(
        customer_log(src), customers_before_log(src, d0), "CustomerName", LOG_TRACKED, "CustomerKey")


def late_customers(src: Oltp) -> DataFrame:
    """The customers fixture run ten days after its dimension began; then the state of the fifth day arrives.

    On the fifth day names ending in 3 were absent, and names ending in 4 had another category.
    """
    dim, stage, spec, d0 = M.scd2_inputs(src, "customers")
    (key,) = spec.business_key
    fifth, tenth = d0 + dt.timedelta(days=5), d0 + dt.timedelta(days=10)
    known = materialize(M.apply_scd2(spec, stage, dim, tenth, tenth - dt.timedelta(days=1)))
    last = F.right(F.rtrim(key), F.lit(1))
    told = stage.where(last != "3").withColumn("CustomerCategoryName", F.when(
        last == "4", F.concat(F.lit("MID "), F.col("CustomerCategoryName"))).otherwise(F.col("CustomerCategoryName")))
    return scd_history.scd2_insert(told, known, key, list(spec.attrs), spec.key_col, fifth, tenth)[0]


def periods_out_of_order(spark: SparkSession, sf_dir: str) -> Mart:
    """The three periods of the changing source, the middle one loaded last, with its members as they were."""
    mart = Mart(spark)
    bounds = changing.periods(*M.order_date_bounds(Oltp(spark, sf_dir)))
    for period in (0, 2, 1):
        M.run_dates(changing.ChangingOltp(spark, sf_dir, period), mart, *bounds[period], members_as_of_start=True)
    return mart


def changed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(CustomerName, CHANGE) of the changing source's customers between its second and third period, by digests."""
    spec = M.CUSTOMERS
    keys, attrs = list(spec.business_key), list(spec.attrs)
    before, now = (M._stage_for(spec, M.ex.extract_customers(changing.ChangingOltp(spark, sf_dir, p))) for p in (1, 2))
    diff = materialize(digests.digest_diff(
        digests.member_digests(before, keys, attrs), digests.member_digests(now, keys, attrs)))
    told = lambda df, which: digests.with_key_digest(df, keys).join(
        diff.where(which), digests.KEY_DIGEST).select(*keys, "CHANGE").distinct()
    return told(now, "CHANGE <> 'gone'").unionByName(told(before, "CHANGE = 'gone'"))


def kept_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary from the parts of three loads, the third of which loads some dates of the second again."""
    src, mart = Oltp(spark, sf_dir), Mart(spark)
    first, last = M.order_date_bounds(src)
    middle = first + (last - first) / 2
    for start, end in ((first, first), (first + dt.timedelta(days=1), last), (middle, last)):
        M.run_dates(src, mart, start, end, keep_summary=True)
    return M.kept_summary(mart)


class LateMembers(Oltp):
    """The order database before some members are entered: customers 1 mod 40, and products 2 mod 50."""

    @cached_property
    def customers(self) -> DataFrame:
        return super().customers.where("CustomerID % 40 <> 1")

    @cached_property
    def stock_items(self) -> DataFrame:
        return super().stock_items.where("StockItemID % 50 <> 2")


def late_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by member: all dates but the last are loaded before some members are entered, the last one after."""
    src, early, mart = Oltp(spark, sf_dir), LateMembers(spark, sf_dir), Mart(spark)
    first, last = M.order_date_bounds(src)
    M.run_dates(early, mart, first, last - dt.timedelta(days=1), late_members=True)
    M.run_dates(src, mart, last, last, late_members=True)
    return changing.sales(mart)
