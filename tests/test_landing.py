"""The landing zone: same extracts, lines that are not shuffled, and days that read their month only."""

import datetime as dt

from pyspark.sql import functions as F

from dimwright.plans import extract as ex
from dimwright.plans import mart as M
from dimwright.sources.landing import land
from dimwright.sources.oltp import Oltp
from test_mart import executed_plan

SF = "/root/testdata/sf0.001"


def tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_landing_zone(spark):
    src = Oltp(spark, SF)
    there = land(src)
    first, last = M.order_date_bounds(there)
    assert (first, last) == M.order_date_bounds(src)
    assert tuples(ex.extract_orders(there)) == tuples(ex.extract_orders(src))
    middle = first + dt.timedelta(days=45)
    for a, b in ((first, first), (middle, middle + dt.timedelta(days=40)), (last, last)):
        assert tuples(ex.extract_orders(there, a, b)) == tuples(ex.extract_orders(src, a, b))
    # All dates: orders are dealt to the lines' buckets, lines stay where they are.
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        headers = there.orders().join(there.order_lines, "OrderID", "left")
        plan = executed_plan(headers).split("== Initial Plan ==")[0]
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        wide = ex.order_headers(there).join(there.order_lines, "OrderID", "left")
        plan = executed_plan(wide).split("== Initial Plan ==")[0].splitlines()
        at = next(i for i, ln in enumerate(plan) if "landing_lines" in ln)
        join = max(i for i, ln in enumerate(plan[:at]) if "SortMergeJoin" in ln or ":" not in ln[: ln.find("- ") + 1])
        assert not any("Exchange" in ln for ln in plan[max(join, at - 5) : at]), plan[max(join, at - 5) : at + 1]
        assert sum("Exchange hashpartitioning(OrderID" in ln for ln in plan) == 1  # the headers
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # A day reads the files of its month: a share of the table.
    day = there.lines(middle, middle)
    assert 0 < len(day.inputFiles()) < 0.1 * len(there.order_lines.inputFiles())
    months = ex.extract_orders(there, middle, middle)
    assert f"OrderMonth#" in executed_plan(months) and "PartitionFilters: [" in executed_plan(months)
    there.drop()
    assert not [t for t in spark.catalog.listTables() if t.name in (there.orders_table, there.lines_table)]


def test_lines_of_unknown_orders_are_kept(spark):
    class Loose(Oltp):
        def orders(self, start=None, end=None):
            return super().orders(start, end).where(F.col("OrderID") % 2 == 0)

    src = Loose(spark, SF)
    there = land(src, buckets=4)
    assert there.order_lines.count() == src.order_lines.count()
    assert tuples(ex.extract_orders(there)) == tuples(ex.extract_orders(src))
    there.drop()
