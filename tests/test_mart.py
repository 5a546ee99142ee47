"""Calendar, measures, as-of fact lookups, loads and guards (FIXTURES.md §6)."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from dimwright.functions.dates import calendar_columns
from dimwright.functions.measures import total_after_tax, total_before_tax
from dimwright.operators import quality
from dimwright.operators.load import EmptyExtractError, Mart, upsert_by_key, write_guarded
from dimwright.plans import mart as M
from dimwright.session import work_path

d, D = dt.date, decimal.Decimal
SF = "/root/testdata/sf0.001"


def test_calendar_rows(spark):
    df = spark.createDataFrame([(d(2013, 1, 1),), (d(2012, 2, 29),)], "x date")
    got = {tuple(r) for r in df.select(*calendar_columns(F.col("x"))).collect()}
    assert got == {
        (20130101, d(2013, 1, 1), 2013, 1, 1, 1, d(2013, 1, 1), d(2013, 1, 31), "January", "Tuesday"),
        (20120229, d(2012, 2, 29), 2012, 2, 29, 1, d(2012, 2, 1), d(2012, 2, 29), "February", "Wednesday"),
    }


def test_measures(spark):
    df = spark.createDataFrame([(3, D("2.35"), D("15.000"))], "q int, p decimal(18,2), t decimal(18,3)")
    r = df.select(total_before_tax(F.col("q"), F.col("p")).alias("b"),
                  total_after_tax(F.col("q"), F.col("p"), F.col("t")).alias("a")).first()
    assert (r.b, r.a) == (D("7.05"), D("8.11"))


STAGE_SCHEMA = ("OrderDate date, Quantity int, UnitPrice decimal(18,2), TaxRate decimal(18,3), CustomerName string, "
                "CityName string, StateProvinceName string, CountryName string, StockItemName string, "
                "LogonName string, PickingStaffName string")


@pytest.fixture(scope="module")
def dims(spark):
    def t2(rows, key, bk, attrs):
        schema = f"{key} long, {bk} string, " + ", ".join(f"{a} string" for a in attrs) + \
            ", StartDate date, EndDate date"
        return spark.createDataFrame(rows, schema)

    return {
        "customers": t2([(2, "b", "x", d(2013, 1, 1), d(2013, 1, 1)), (8, "b", "y", d(2013, 1, 2), None)],
                        "CustomerKey", "CustomerName", ["CustomerCategoryName"]),
        "cities": spark.createDataFrame([(1, "Rome", "Lazio", "Italy")],
                                        "CityKey long, CityName string, StateProvName string, CountryName string"),
        "products": t2([(5, "bolt #1", "red", d(2013, 1, 1), None)], "ProductKey", "ProductName", ["ProductColour"]),
        "salespeople": spark.createDataFrame([(3, "s.1")], "SalespersonKey long, LogonName string"),
        "picking_staff": t2([(4, "p.1", "P", d(2013, 1, 1), None)], "PickingStaffKey", "LogonName", ["FullName"]),
    }


@pytest.fixture(scope="module")
def stage(spark):
    base = ("Rome", "Lazio", "Italy", "bolt #1", "s.1")
    return spark.createDataFrame([
        (d(2013, 1, 1), 3, D("2.35"), D("15.000"), "b", *base, "p.1"),
        (d(2013, 1, 2), 1, D("1.00"), D("0.000"), "b", *base, "p.1"),
        (d(2013, 1, 2), 1, D("1.00"), D("0.000"), "b", *base, None),
        (d(2013, 1, 2), None, None, None, "b", *base, "p.1"),
    ], STAGE_SCHEMA)


def test_fact_asof_unknown_and_no_lines(stage, dims):
    got = sorted((r.DateKey, r.CustomerKey, r.PickingStaffKey, r.TotalAfterTax)
                 for r in M.fact_orders(stage, dims).collect())
    assert got == [(20130101, 2, 4, D("8.11")), (20130102, 8, -1, D("1.00")), (20130102, 8, 4, D("1.00"))]


def test_fact_strict_drops_unknown(stage, dims):
    assert M.fact_orders(stage, dims, strict=True).count() == 2


def test_fact_row_count_equals_staged_lines(stage, dims):
    staged = stage.filter(F.col("Quantity").isNotNull()).count()
    assert M.fact_orders(stage, dims).count() == staged  # no fan-out


def test_fact_date_reload_is_idempotent(spark, stage, dims):
    mart = Mart(spark)
    fact = M.fact_orders(stage, dims)
    mart.write_fact(fact)
    first = sorted(tuple(r) for r in mart.read_fact().collect())
    mart.write_fact(fact)
    assert sorted(tuple(r) for r in mart.read_fact().collect()) == first


def test_guard_raises_on_empty_extract(spark, stage):
    with pytest.raises(EmptyExtractError):
        write_guarded(stage.filter(F.lit(False)), work_path(spark, "empty"), "orders")
    assert write_guarded(stage, work_path(spark, "full"), "orders") == 4


def test_upsert_twice_equals_once(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    pre = spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string")
    once = upsert_by_key(cur, pre, "k")
    twice = upsert_by_key(once, pre, "k")
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()} == {(1, "a"), (2, "B"), (3, "c")}


def test_mart_publish_versions(spark):
    mart = Mart(spark)
    mart.publish("t", spark.createDataFrame([(1,)], "k long"))
    mart.publish("t", spark.createDataFrame([(1,), (2,)], "k long"))
    assert mart.read("t").count() == 2
    again = Mart(spark, mart.root)  # a new job finds the current version in the manifest
    assert again.read("t").count() == 2


def test_quality_checks(spark):
    fact = spark.createDataFrame([(1, None), (1, 5), (9, 5)], "CustomerKey long, Other long")
    dim = spark.createDataFrame([(1,)], "CustomerKey long")
    assert [tuple(r) for r in quality.duplicate_keys(fact, ["CustomerKey"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.orphan_keys(fact, {"CustomerKey": (dim, "CustomerKey")}).collect()] == \
        [("CustomerKey", 9, 1)]
    got = {r.COLUMN_NAME: r.NULL_COUNT for r in quality.null_counts(fact).collect()}
    assert got == {"CustomerKey": 0, "Other": 1}


def test_s04_empty_and_refill(spark):
    """A stage write replaces the previous contents (TRUNCATE + INSERT)."""
    path = work_path(spark, "stage")
    write_guarded(spark.createDataFrame([(1,), (2,)], "k long"), path, "stage")
    write_guarded(spark.createDataFrame([(3,)], "k long"), path, "stage")
    assert [r.k for r in spark.read.parquet(path).collect()] == [3]


def test_d1_conform_selects_by_name(spark):
    from dimwright.plans.schemas import FACT_ORDERS, conform

    shuffled = spark.createDataFrame(
        [(7, 20130101, 5, 1, 2, 3, 4, D("1.00"), D("0.000"), D("7.00"), D("7.00"), "extra")],
        "Quantity int, DateKey int, PickingStaffKey long, CustomerKey long, CityKey long, ProductKey long, "
        "SalespersonKey long, UnitPrice decimal(18,2), TaxRate decimal(18,3), TotalBeforeTax decimal(18,2), "
        "TotalAfterTax decimal(18,2), Junk string")
    out = conform(shuffled, FACT_ORDERS)
    assert out.columns == [f.name for f in FACT_ORDERS.fields]
    r = out.first()
    assert (r.CustomerKey, r.DateKey, r.PickingStaffKey, r.Quantity) == (1, 20130101, 5, 7)


def test_d4_picking_staff_distinct_and_no_null_logons(spark):
    from dimwright.plans import extract as ex
    from dimwright.sources.oltp import Oltp

    staff = ex.extract_picking_staff(Oltp(spark, "/root/testdata/sf0.001"), keep_id=True).collect()
    ids = [r.PersonID for r in staff]
    assert len(ids) == len(set(ids)) and all(r.LogonName for r in staff)


def executed_plan(df) -> str:
    """The final adaptive plan of ``df`` itself, after running it."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fact_lookups_without_broadcast_match(stage, dims, no_broadcast):
    """Shuffled lookups give the same rows and read the stage once."""
    shuffled = M.fact_orders(stage, dims)
    assert "BroadcastHashJoin" not in executed_plan(shuffled)
    got = sorted((r.DateKey, r.CustomerKey, r.PickingStaffKey, r.TotalAfterTax) for r in shuffled.collect())
    assert got == [(20130101, 2, 4, D("8.11")), (20130102, 8, -1, D("1.00")), (20130102, 8, 4, D("1.00"))]


def test_fact_reads_each_source_once_without_broadcast(spark, no_broadcast):
    from dimwright.plans import extract as ex
    from dimwright.sources.oltp import Oltp

    src = Oltp(spark, SF)
    fact = M.fact_orders(ex.extract_orders(src), M.build_dimensions(src, M.first_order_date(src)))
    plan = executed_plan(fact).split("== Initial Plan ==")[0]
    assert plan.count("lineitem.parquet") == 1 and plan.count("/orders.parquet") == 1


def test_daily_runs_persist_and_rerun_changes_nothing(spark):
    """Two runs into one mart folder, the second date run twice: the fact and
    every dimension version are unchanged by the re-run; the quality report
    shows only the unknown-member orphans."""
    from dimwright.sources.oltp import Oltp

    src = Oltp(spark, "/root/testdata/sf0.001")
    root = work_path(spark, "mart-test")
    d0 = M.first_order_date(src)
    M.run_dates(src, Mart(spark, root), d0, d0)
    d1 = d0 + dt.timedelta(days=30)
    M.run_dates(src, Mart(spark, root), d0 + dt.timedelta(days=1), d1)
    reopened = Mart(spark, root)  # a later job finds the current versions
    before_fact = sorted(tuple(r) for r in reopened.read_fact().collect())
    before_dims = {s.name: sorted(map(tuple, reopened.read(s.name).collect())) for s in M.SPEC_BY_DIM.values()}
    M.run_dates(src, reopened, d0 + dt.timedelta(days=1), d1)
    after = Mart(spark, root)
    assert sorted(tuple(r) for r in after.read_fact().collect()) == before_fact
    for s in M.SPEC_BY_DIM.values():
        assert sorted(map(tuple, after.read(s.name).collect())) == before_dims[s.name]
    report = M.check_mart(after).collect()
    assert all(r.CHECK == "orphan_key" and r.KEY_VALUE == -1 for r in report)


def test_hot_date_is_split_across_tasks(spark):
    """All rows on one date: the rebalanced write spreads them over several
    files (tasks) once they exceed AQE's advisory partition size."""
    rows = spark.range(20000).select(
        F.lit(20130101).alias("DateKey"), (F.col("id") % 97).alias("CustomerKey"), F.col("id").alias("ProductKey"),
        F.col("id").cast("string").alias("payload"))
    mart = Mart(spark)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
        mart.write_fact(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    back = mart.read_fact()
    assert back.count() == 20000
    assert len(back.inputFiles()) > 1


def test_command_line_load_and_check(spark, capsys):
    from dimwright.__main__ import main

    root = work_path(spark, "mart-cli")
    assert main(["load", "--src", "/root/testdata/sf0.001", "--mart", root, "--start", "1995-01-01",
                 "--end", "1995-01-02"]) == 0
    assert "fact rows" in capsys.readouterr().out
    assert main(["check", "--mart", root]) == 0
    assert "CHECK" in capsys.readouterr().out  # the report's header
    assert Mart(spark, root).read_fact().count() > 0


def test_incremental_run_keeps_history(spark):
    """A later run reads the published versions: unchanged rows keep their
    first-load StartDate and keys; nothing is re-opened from scratch."""
    from dimwright.sources.oltp import Oltp

    src = Oltp(spark, "/root/testdata/sf0.001")
    mart = Mart(spark)
    d0 = M.first_order_date(src)
    M.run_dates(src, mart, d0, d0)
    first = {s.name: sorted(map(tuple, mart.read(s.name).collect())) for s in M.SPEC_BY_DIM.values()}
    M.run_dates(src, mart, d0 + dt.timedelta(days=1), d0 + dt.timedelta(days=5))
    for s in M.SPEC_BY_DIM.values():
        assert sorted(map(tuple, mart.read(s.name).collect())) == first[s.name], s.name
    starts = {r.StartDate for r in mart.read(M.CUSTOMERS.name).collect()}
    assert starts == {d0}
    # nothing changed in the sources: no dimension was rewritten
    assert all(Mart(spark, mart.root)._versions[s.name] == 1 for s in M.SPEC_BY_DIM.values())
    # re-running the same dates adds no calendar rows: no new calendar version
    v = Mart(spark, mart.root)._versions["dim_date"]
    M.run_dates(src, mart, d0 + dt.timedelta(days=1), d0 + dt.timedelta(days=5))
    assert Mart(spark, mart.root)._versions["dim_date"] == v


def test_adds_rows(spark):
    from dimwright.operators.load import adds_rows

    cur = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")
    assert not adds_rows(spark.createDataFrame([(2, None)], "k long, v string"), cur)
    assert adds_rows(spark.createDataFrame([(2, "b")], "k long, v string"), cur)
    assert adds_rows(spark.createDataFrame([(3, "c")], "k long, v string"), cur)


def test_members_missing_from_stage_are_kept(spark):
    """Customers of one nation vanish from the source before the second run:
    the type-1 city row stays (load is an upsert), their type-2 customer rows
    are closed, not removed."""
    from functools import cached_property

    from dimwright.sources.oltp import Oltp

    class Shrunk(Oltp):
        @cached_property
        def customers(self):
            return super().customers.filter(F.col("DeliveryCityID") != 0)

    sf = "/root/testdata/sf0.001"
    mart = Mart(spark)
    src = Oltp(spark, sf)
    d0 = M.first_order_date(src)
    M.run_dates(src, mart, d0, d0)
    cities_before = {r.CityName for r in mart.read(M.CITIES.name).collect()}
    custs_before = mart.read(M.CUSTOMERS.name).count()
    M.run_dates(Shrunk(spark, sf), mart, d0 + dt.timedelta(days=1), d0 + dt.timedelta(days=3))
    assert {r.CityName for r in mart.read(M.CITIES.name).collect()} == cities_before
    after = mart.read(M.CUSTOMERS.name).collect()
    assert len(after) == custs_before
    closed = [r for r in after if r.EndDate is not None]
    assert closed and all(r.EndDate == d0 for r in closed)


# -- safety of the mart -----------------------------------------------------------
def small_source(spark, without: set | None = None, fix: dict | None = None):
    """sf0.001, optionally without the orders of some dates and with other customer categories."""
    from functools import cached_property

    from dimwright.sources.oltp import Oltp

    class Source(Oltp):
        def orders(self, start=None, end=None):
            rows = super().orders(start, end)
            return rows.filter(~F.col("OrderDate").isin(list(without))) if without else rows

        @cached_property
        def customers(self):
            c = super().customers
            for key, category in (fix or {}).items():
                c = c.withColumn("CustomerCategoryID", F.when(F.col("CustomerID") == key, F.lit(category))
                                 .otherwise(F.col("CustomerCategoryID")))
            return c

        @cached_property
        def customer_categories(self):
            return self.customers.select("CustomerCategoryID").distinct().withColumn(
                "CustomerCategoryName", F.col("CustomerCategoryID"))

    return Source(spark, SF)


def first_dates(src, n):
    rows = src.orders().select("OrderDate").distinct().orderBy("OrderDate").limit(n).collect()
    return [r.OrderDate for r in rows]


def test_damaged_manifest_is_an_error(spark, tmp_path):
    import glob

    mart = Mart(spark, f"file://{tmp_path}/mart")
    mart.publish("t", spark.createDataFrame([(1,)], "k long"))
    mart.publish("t", spark.createDataFrame([(2,)], "k long"))
    for f in glob.glob(f"{tmp_path}/mart/_manifest/part-*"):
        with open(f, "wb") as out:
            out.write(b"damaged")
    with pytest.raises(Exception):
        Mart(spark, f"file://{tmp_path}/mart")
    versions = sorted(p.name for p in (tmp_path / "mart" / "t").iterdir())
    assert versions == ["v=1", "v=2"]


def test_a_folder_is_never_written_twice(spark):
    mart = Mart(spark)
    rows = mart.write_versions({"t": spark.createDataFrame([(1,)], "k long")})  # written, never listed
    assert not mart.has("t")
    mart.publish("t", spark.createDataFrame([(2,)], "k long"))
    assert [r.k for r in mart.read("t").collect()] == [2]
    assert [r.k for r in mart.read_written(rows)["t"].collect()] == [1]


def test_empty_orders_publish_nothing(spark):
    mart = Mart(spark)
    src = small_source(spark)
    days = first_dates(src, 1)
    empty = small_source(spark, without=set(days))
    with pytest.raises(EmptyExtractError):
        M.run_dates(empty, mart, days[0], days[0])
    assert mart._versions == {}


def test_date_emptied_at_source_loses_its_rows(spark):
    mart = Mart(spark)
    src = small_source(spark)
    a, b = first_dates(src, 2)
    M.run_dates(src, mart, a, b)
    key = int(f"{b:%Y%m%d}")
    assert mart.read_fact(key, key).count() > 0
    kept = mart.read_fact(int(f"{a:%Y%m%d}"), int(f"{a:%Y%m%d}")).count()
    M.run_dates(small_source(spark, without={b}), mart, a, b)
    assert mart.read_fact(key, key).count() == 0
    assert mart.read_fact().count() == kept
    assert mart.prune(keep=1) >= 1  # the first fact load is in no use any more
    assert mart.read_fact().count() == kept


def test_correction_on_the_same_date_is_settled_in_place(spark):
    mart = Mart(spark)
    src = small_source(spark)
    a, b = first_dates(src, 2)
    M.run_dates(src, mart, a, b)
    M.run_dates(small_source(spark, fix={1: "FIXED", 2: "FIXED"}), mart, a, b)
    rows = mart.read(M.CUSTOMERS.name).collect()
    assert all(r.EndDate is None for r in rows)
    assert sum(r.CustomerCategoryName == "FIXED" for r in rows) == 2


def test_backfilled_dates_find_their_members(spark):
    """Later dates first: the earlier ones load against the history as it stands, first versions covering them."""
    mart = Mart(spark)
    src = small_source(spark)
    days = first_dates(src, 12)
    M.run_dates(src, mart, days[6], days[11])
    before = {s.name: sorted(map(tuple, mart.read(s.name).collect())) for s in M.SPEC_BY_DIM.values()}
    M.run_dates(src, mart, days[0], days[5])
    assert mart.read_fact().filter("CustomerKey = -1 or ProductKey = -1").count() == 0
    for s in M.SPEC_BY_DIM.values():
        assert sorted(map(tuple, mart.read(s.name).collect())) == before[s.name]


def test_a_run_leaves_no_scratch_folders(spark):
    import os

    from dimwright.session import ensure_checkpoint_dir

    mart = Mart(spark)
    src = small_source(spark)
    day = first_dates(src, 1)[0]
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    work = f"{root}/dimwright/{spark.sparkContext.applicationId}"

    def scratch():
        return {n for n in os.listdir(work) if n.startswith("materialized")}

    before = scratch()
    M.run_dates(src, mart, day, day)
    assert scratch() == before


def test_written_tables_have_the_declared_schema(spark):
    from dimwright.plans.schemas import SCHEMAS

    mart = Mart(spark)
    src = small_source(spark)
    day = first_dates(src, 1)[0]
    M.run_dates(src, mart, day, day)
    for table in [s.name for s in M.SPEC_BY_DIM.values()] + ["dim_date"]:
        got = [(f.name, f.dataType) for f in mart.read(table).schema.fields]
        assert got == [(f.name, f.dataType) for f in SCHEMAS[table].fields], table
    fact = {f.name: f.dataType for f in mart.read_fact().schema.fields}
    assert fact == {f.name: f.dataType for f in SCHEMAS["fact_orders"].fields}


def test_changing_source_run_and_late_rerun(spark):
    """Re-running the first period after the third (an older run) leaves every version and every sale as it was."""
    from dimwright.plans import changing

    mart = changing.run_periods(spark, SF)
    sales = sorted(map(tuple, changing.sales(mart).collect()), key=str)
    bounds = M.order_date_bounds(changing.ChangingOltp(spark, SF, 0))
    start, end = changing.periods(*bounds)[0]
    M.run_dates(changing.ChangingOltp(spark, SF, 0), mart, start, end)
    assert sorted(map(tuple, changing.sales(mart).collect()), key=str) == sales
    for row in mart.read(M.CUSTOMERS.name).collect():
        assert row.EndDate is None or row.StartDate <= row.EndDate
