"""What a run of the mart moves and computes: members once per order, products by id, no extract twice."""

import datetime as dt

from pyspark.sql import functions as F

from dimwright.functions.semantics import cents_of, half_up_quotient
from dimwright.operators.joins import asof_lookup, versions_by_id
from dimwright.operators.load import Mart
from dimwright.plans import extract as ex
from dimwright.plans import mart as M
from test_mart import first_dates, small_source


def tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_staged_lines_carry_no_text_and_give_the_same_fact(spark):
    src = small_source(spark)
    a, b = first_dates(src, 2)
    mart = Mart(spark)
    M.run_dates(src, mart, a, b)
    lines = spark.read.parquet(f"{mart.root}/_stage/order_lines")
    assert not any(t == "string" for _, t in lines.dtypes)
    headers = spark.read.parquet(f"{mart.root}/_stage/order_headers")
    assert headers.count() == headers.select("OrderID").distinct().count() == src.orders(a, b).count()
    dims = {k: mart.read(spec.name) for k, spec in M.SPEC_BY_DIM.items()}
    wide = M.fact_orders(ex.extract_orders(src, a, b), dims, first_covers_earlier=True)
    assert tuples(mart.read_fact().select(*M.FACT_COLUMNS)) == tuples(wide.select(*M.FACT_COLUMNS))


def test_versions_by_id_equal_the_lookup_by_name(spark):
    day = lambda n: dt.date(2020, 1, n)
    dim = spark.createDataFrame(
        [(1, "A ", day(5), day(9)), (2, "a", day(10), None), (3, "b", day(3), day(4)), (4, None, day(1), None)],
        "K long, name string, StartDate date, EndDate date")
    names = spark.createDataFrame([(10, "a"), (11, "B"), (12, None), (13, "zz"), (14, "A")], "id long, name string")
    facts = spark.createDataFrame(
        [(i, i % 6 + 10 if i % 7 else None, day(1 + i % 12)) for i in range(84)], "n long, id long, d date")
    for first in (False, True):
        for how in ("left", "inner"):
            by_name = asof_lookup(facts.join(names, "id", "left"), dim, ["name"], ["name"], "d", {"K": "K"}, how, first)
            by_id = asof_lookup(facts, versions_by_id(names, "id", "name", dim, "name", ["K"], first),
                                ["id"], ["id"], "d", {"K": "K"}, how)
            assert tuples(by_name.select("n", "K")) == tuples(by_id.select("n", "K"))


def test_late_members_extract_each_date_once(spark):
    """The run that finds late members reads the lines of its own dates and of those built anew, nothing twice."""
    src = small_source(spark)
    days = first_dates(src, 3)
    missing = [r.CustomerID for r in src.orders(days[0], days[1]).select("CustomerID").collect()][:2]
    item = src.lines().select("StockItemID").first()[0]
    read = []

    class Now(type(src)):
        def lines(self, start=None, end=None):
            read.append((start, end))
            return src.lines(start, end)

    class Early(Now):
        @property
        def customers(self):
            return src.customers.where(~F.col("CustomerID").isin(missing))

        @property
        def stock_items(self):
            return src.stock_items.where(F.col("StockItemID") != item)

    mart = Mart(spark)
    M.run_dates(Early(spark, src.sf_dir), mart, days[0], days[1], late_members=True)
    lines = src.lines().join(src.orders(days[0], days[1]), "OrderID")
    waiting = mart.read_parts(M.UNRESOLVED).select("MEMBER", "SourceID").distinct()
    want = {("customers", c) for c in missing} | (
        {("products", item)} if lines.where(F.col("StockItemID") == item).count() else set())
    assert {tuple(r) for r in waiting.collect()} == want
    assert len(read) == 1
    M.run_dates(Now(spark, src.sf_dir), mart, days[2], days[2], late_members=True)
    assert len(read) == 3  # own dates, and those built anew
    assert mart.read_fact().where("CustomerKey = -1 or ProductKey = -1").count() == 0


def test_a_load_computes_its_fact_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def told(n):
        seen.add(1)
        return n

    rows = spark.range(60).select(F.udf(told, "long")("id").alias("ProductKey"),
                                  (F.lit(20130101) + F.col("id") % 3).cast("int").alias("DateKey"))
    # The date is told by the same pass, so none may be pruned away from it.
    rows = rows.withColumn("DateKey", F.when(F.col("ProductKey") < 0, -1).otherwise(F.col("DateKey")))
    mart = Mart(spark)
    assert mart.write_fact(rows) == 60
    assert seen.value == 60
    assert [(r["first_key"], r["last_key"]) for r in mart._rows] == [(20130101, 20130103)]
    assert mart.write_fact(rows.where("ProductKey < 0")) == 0 and mart.read_fact().count() == 60


def test_cents_equal_the_decimal_cast(spark):
    values = [1.005, 0.615, -0.005, 2.675, 0.0, -0.0, 1e-300, 84197.04, -17.5, 123456789012.345, 9e15, None]
    df = spark.createDataFrame([(v,) for v in values], "x double").unionByName(
        spark.range(2000).select((F.round(F.rand(1) * 100_000, 3)).alias("x")))
    slow = (F.col("x").cast("decimal(18,2)") * 100).cast("long")
    assert df.where(~cents_of(F.col("x")).eqNullSafe(slow)).count() == 0
    plan = df.select(half_up_quotient(F.col("x").cast("long"), F.lit(3)))._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal" not in plan
