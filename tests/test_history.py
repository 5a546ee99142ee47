"""Histories of many days, late days, carried-forward lookups, block totals, and facts of very many loads."""

import datetime as dt
import random
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimwright.operators import grouped, profile, scd_history
from dimwright.operators.joins import asof_carry, asof_lookup
from dimwright.operators.load import Mart, as_date, as_key, date_ranges
from dimwright.operators.scd import BackdatedRunError, scd2
from dimwright.plans import history
from dimwright.plans import mart as M
from test_mart import executed_plan, first_dates, small_source

SF = "/root/testdata/sf0.001"
DIM = "k long, name string, cat string, tier string, StartDate date, EndDate date"
LOG = "name string, cat string, tier string, LogDate date, Gone boolean"
STAGE = "name string, cat string, tier string"
D0 = dt.date(2013, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def tuples(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=str)


# -- facts of very many loads -------------------------------------------------------
def test_facts_of_four_thousand_loads(spark, tmp_path):
    """One load a day for eleven years, some days loaded again: read in seconds, pruned to the loads in use."""
    days = [as_key(day(i)) for i in range(3_600)]
    loads = [(n + 1, key) for n, key in enumerate(days + days[:400])]
    root = tmp_path / "mart"
    (root / "_manifest").mkdir(parents=True)
    for run, key in loads:
        folder = root / "fact_orders" / f"run={run}" / f"DateKey={key}"
        folder.mkdir(parents=True)
        pq.write_table(pa.table({"CustomerKey": pa.array([run], pa.int64()), "Quantity": pa.array([1], pa.int32())}),
                       folder / "part-0.parquet")
    versions, keys = zip(*loads)
    for at in range(0, len(loads), 100):
        pq.write_table(pa.table({
            "table": ["fact_orders"] * 100, "version": pa.array(versions[at : at + 100], pa.int32()),
            "first_key": pa.array(keys[at : at + 100], pa.int32()),
            "last_key": pa.array(keys[at : at + 100], pa.int32())}), root / "_manifest" / f"part-{at}.parquet")
    began = time.time()
    mart = Mart(spark, f"file://{root}")
    fact = mart.read_fact()
    got = dict(map(tuple, fact.select("DateKey", "CustomerKey").collect()))
    assert got == {key: run for run, key in loads}  # the newest load of each day
    assert time.time() - began < 60
    some = mart.read_fact(days[10], days[19])
    plan = executed_plan(some)
    assert "dynamicpruning" in plan and f"(DateKey" in plan and "PartitionFilters: [" in plan
    assert sorted(r.CustomerKey for r in some.collect()) == [3_600 + i for i in range(11, 21)]
    assert some.columns == ["CustomerKey", "Quantity", "DateKey"]


def test_date_ranges():
    keys = [20121230, 20121231, 20130101, 20130103]
    assert date_ranges(keys) == [(20121230, 20130101), (20130103, 20130103)] and date_ranges([]) == []
    assert as_key(as_date(20240229)) == 20240229


# -- many days in one pass -------------------------------------------------------------
def successive(spark, log, dim):
    """One scd2 run per day of the log, each with the state of all members on that day."""
    for d in sorted({r[3] for r in log}):
        state = {}
        for name in {r[0].lower().rstrip() for r in log}:
            told = [r for r in log if r[0].lower().rstrip() == name and r[3] <= d]
            if told:
                newest = max(r[3] for r in told)
                told = [r for r in told if r[3] == newest]
                present = [r for r in told if not r[4]]
                state[name] = min(present, key=lambda r: (r[1], r[2], r[0])) if present else None
        for r in dim:  # members that the log has not named yet
            if r[5] is None and r[1].lower().rstrip() not in state:
                state[r[1].lower().rstrip()] = (r[1], r[2], r[3])
        stage = [r[:3] for r in state.values() if r]
        dim = [tuple(r) for r in scd2(
            spark.createDataFrame(stage, STAGE), spark.createDataFrame(dim, DIM), "name", ["cat", "tier"], "k", d,
            d - dt.timedelta(days=1)).select("k", "name", "cat", "tier", "StartDate", "EndDate").collect()]
    return dim


@pytest.mark.parametrize("seed", [1, 2])
def test_change_log_equals_successive_runs(spark, seed):
    rng = random.Random(seed)
    dim = [(5, "a", "x", "1", day(-3), None), (7, "B", "x", None, day(-3), None), (9, "old", "x", "1", day(-9), day(-5)),
           (8, "a", "w", "1", day(-9), day(-4))]
    names = ["a", "A ", "b", "c", "old", "E"]
    log = [(rng.choice(names), rng.choice(["x", "y", "X "]), rng.choice(["1", "2"]), day(rng.randrange(5)), rng.random() < 0.2)
           for _ in range(25)]
    got = scd_history.scd2_change_log(
        spark.createDataFrame([*log, (None, "x", "1", day(1), False), ("a", "z", "1", None, False)], LOG),
        spark.createDataFrame(dim, DIM), "name", ["cat", "tier"], "k")
    assert tuples(got, "k", "name", "cat", "tier", "StartDate", "EndDate") == sorted(successive(spark, log, dim), key=str)


def test_change_log_edges(spark):
    dim = spark.createDataFrame([(1, "a", "x", "1", day(0), None)], DIM)
    none = spark.createDataFrame([], LOG)
    assert tuples(scd_history.scd2_change_log(none, dim, "name", ["cat", "tier"], "k")) == tuples(dim)
    with pytest.raises(BackdatedRunError):
        scd_history.scd2_change_log(spark.createDataFrame([("a", "y", "1", day(0), False)], LOG), dim, "name",
                                    ["cat", "tier"], "k")
    log = spark.range(2000).select(
        F.lit("hot").alias("name"), (F.col("id") % 2).cast("string").alias("cat"), F.lit("1").alias("tier"),
        F.date_add(F.lit(str(day(1))).cast("date"), F.col("id").cast("int")).alias("LogDate"), F.lit(False).alias("Gone"))
    got = scd_history.scd2_change_log(log, spark.createDataFrame([], DIM), "name", ["cat", "tier"], "k")
    assert [r.k for r in got.orderBy("StartDate").collect()] == list(range(1, 2001))
    assert got.where("EndDate is null").count() == 1 and got.where("EndDate <> StartDate").count() == 0


# -- late days ---------------------------------------------------------------------------
states = st.dictionaries(st.sampled_from("abc"), st.tuples(st.sampled_from("xy"), st.sampled_from("12")), max_size=3)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(states, min_size=2, max_size=4).flatmap(
    lambda told: st.tuples(st.just(told), st.permutations(range(len(told))))))
def test_any_order_of_days_gives_the_same_history(spark, case):
    told, order = case

    def load(days):
        dim, seen = [], []
        for n in days:
            stage = spark.createDataFrame([(k, *v) for k, v in told[n].items()], STAGE)
            before = spark.createDataFrame(dim, DIM)
            later = [m for m in seen if m > n]
            if later:
                after, moved = scd_history.scd2_insert(
                    stage, before, "name", ["cat", "tier"], "k", day(2 * n), day(2 * min(later)))
                check_moved(dim, [tuple(r) for r in after.collect()], moved.collect(), day(2 * n), day(2 * min(later)))
            else:
                after = scd2(stage, before, "name", ["cat", "tier"], "k", day(2 * n), day(2 * n - 1))
            dim = [tuple(r) for r in after.select("k", "name", "cat", "tier", "StartDate", "EndDate").collect()]
            seen.append(n)
        assert len({r[0] for r in dim}) == len(dim)
        return sorted((r[1:] for r in dim), key=str)

    assert load(order) == load(sorted(order))


def check_moved(before, after, moved, first, until):
    """A fact outside the span finds the right version by its old key and ``moved``."""
    for r in before:
        for n in range(0, 12):
            d = day(n)
            if r[4] <= d <= (r[5] or day(99)) and not first <= d < until:
                spans = [m.NewKey for m in moved if m.k == r[0] and m.FirstDay <= d <= (m.LastDay or day(99))]
                assert len(spans) <= 1
                now = [x[0] for x in after if x[1] == r[1] and x[4] <= d <= (x[5] or day(99))]
                assert now == [spans[0] if spans else r[0]], (r, d, moved, after)


def test_a_split_version_moves_its_later_facts(spark):
    dim = spark.createDataFrame([(1, "a", "x", "1", day(0), None)], DIM)
    told = spark.createDataFrame([("A", "y", "1")], STAGE)
    after, moved = scd_history.scd2_insert(told, dim, "name", ["cat", "tier"], "k", day(3), day(6))
    assert tuples(after) == [(1, "a", "x", "1", day(0), day(2)), (2, "A", "y", "1", day(3), day(5)),
                             (3, "a", "x", "1", day(6), None)]
    assert [tuple(r) for r in moved.collect()] == [(1, 3, day(6), None)]
    facts = spark.createDataFrame([(1, as_key(day(n))) for n in (0, 2, 6, 40)] + [(-1, as_key(day(7)))],
                                  "k long, DateKey int")
    assert [r.k for r in scd_history.rekey(facts, moved, "k").orderBy("DateKey").collect()] == [1, 1, 3, -1, 3]
    same, moved = scd_history.scd2_insert(
        spark.createDataFrame([("a", "x", "1")], STAGE), dim, "name", ["cat", "tier"], "k", day(3), day(6))
    assert tuples(same) == tuples(dim) and moved.isEmpty()
    with pytest.raises(ValueError):
        scd_history.scd2_insert(told, dim, "name", ["cat", "tier"], "k", day(3), day(3))


def test_late_day_in_the_mart(spark):
    """Three days, the middle one last with its members as they were: versions and facts as in order."""
    src = small_source(spark)
    a, b, c = first_dates(src, 3)
    fixed = small_source(spark, fix={n: "FIXED" for n in range(1, 60)})

    def load(order):
        mart = Mart(spark)
        for d in order:
            M.run_dates(fixed if d == b else src, mart, d, d, members_as_of_start=True)
        versions = tuples(mart.read(M.CUSTOMERS.name).drop("CustomerKey"))
        facts = mart.read_fact().join(mart.read(M.CUSTOMERS.name), "CustomerKey", "left").select(
            "DateKey", "CustomerName", "CustomerCategoryName", "StartDate", "Quantity", "UnitPrice", "TaxRate")
        return versions, tuples(facts), mart

    versions, facts, _ = load([a, b, c])
    late_versions, late_facts, mart = load([a, c, b])
    assert late_versions == versions and any("FIXED" in r for r in versions)
    assert late_facts == facts
    assert {r.DateKey for r in mart.read_fact().select("DateKey").collect()} == {as_key(x) for x in (a, b, c)}


# -- carried-forward lookups --------------------------------------------------------------
@pytest.mark.parametrize("block_days", [1, 7, 1000])
def test_asof_carry_equals_the_join(spark, block_days):
    rng = random.Random(block_days)
    versions, key = [], 0
    for name in ("a", "B ", "c"):
        at = day(rng.randrange(5))
        while at < day(60):
            to = at + dt.timedelta(days=rng.randrange(12))
            key += 1
            versions.append((key, name, f"v{key}", "1", at, None if to > day(50) else to))
            if to > day(50):
                break
            at = to + dt.timedelta(days=rng.choice([1, 1, 9]))
    dim = spark.createDataFrame([*versions, (99, None, "n", "1", day(0), None)], DIM)
    facts = spark.createDataFrame(
        [(n, rng.choice(["a", "A ", "b", "c", "unknown", None]), rng.choice([day(rng.randrange(-5, 70)), None]))
         for n in range(400)], "id long, who string, on_day date")
    want = asof_lookup(facts, dim, ["who"], ["name"], "on_day", {"k": "k", "cat": "label"})
    got = asof_carry(facts, dim, ["who"], ["name"], "on_day", {"k": "k", "cat": "label"}, block_days)
    assert got.columns == want.columns and tuples(got) == tuples(want)
    assert asof_carry(facts.limit(0), dim, ["who"], ["name"], "on_day", {"k": "k"}).count() == 0
    assert asof_carry(facts, dim.limit(0), ["who"], ["name"], "on_day", {"k": "k"}).where("k is null").count() == 400


def test_asof_carry_spreads_a_member_of_many_versions(spark):
    """One member with 100,000 versions: no row is multiplied and its facts are carried by many tasks."""
    n = 100_000
    first = F.lit("1800-01-01").cast("date")
    dim = spark.range(n).select(
        F.col("id").alias("k"), F.lit("hot").alias("name"),
        F.date_add(first, F.col("id").cast("int")).alias("StartDate"),
        F.date_add(first, F.col("id").cast("int")).alias("EndDate"))
    facts = spark.range(20_000).select(
        F.col("id"), F.lit("HOT").alias("who"), F.date_add(first, (F.col("id") * 5).cast("int")).alias("on_day"))
    got = asof_carry(facts, dim, ["who"], ["name"], "on_day", {"k": "k"})
    assert got.where("k = id * 5").count() == 20_000 == got.count()
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = asof_carry(facts, dim, ["who"], ["name"], "on_day", {"k": "k"})
        tasks = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["count"] for r in tasks) < 2 * 20_000 / len(tasks)


# -- running totals in blocks -----------------------------------------------------------------
def test_block_totals_equal_the_window(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["u", "v"]), rng.choice([1, 2, 3, 5, 8, None]),
             rng.choice([1, 2, None])) for _ in range(500)]
    rows += [("hot", "u", i // 3, 1) for i in range(3000)] + [("nulls", "u", 1, None), ("nulls", "u", 2, None)]
    df = spark.createDataFrame(rows, "city string, part string, place int, n long")
    for up in (True, False):
        order = F.col("place").asc() if up else F.col("place").desc()
        want = grouped.running_total(df, ["city", "part"], [order], "n", "total")
        got = grouped.running_total_blocks(df, ["city", "part"], [("place", up)], "n", "total", blocks=16)
        assert got.columns == want.columns and tuples(got) == tuples(want)
    assert grouped.running_total_blocks(df.limit(0), ["city"], [("place", True)], "n", "total").count() == 0


def test_a_hot_partition_is_summed_in_blocks(spark):
    """All rows in one partition: its totals are taken by many tasks."""
    df = spark.range(40_000).select(F.lit("hot").alias("city"), F.col("id").alias("place"), F.lit(1).cast("long").alias("n"))
    got = grouped.running_total_blocks(df, ["city"], [("place", True)], "n", "total", blocks=20)
    assert got.where("total = place + 1").count() == 40_000
    plan = executed_plan(got).split("== Initial Plan ==")[0]
    windows = [ln for ln in plan.splitlines() if "Window [sum" in ln]
    assert windows and all("_block" in ln for ln in windows)


# -- catalog ---------------------------------------------------------------------------------
def test_profile_of_the_sessions_tables(spark):
    session = spark.newSession()
    with pytest.raises(ValueError):
        profile.profile_catalog(session)
    session.range(5).createOrReplaceTempView("five")
    session.createDataFrame([("x", 1.5)], "a string, b double").createOrReplaceTempView("other_one")
    assert tuples(profile.profile_catalog(session)) == [
        ("five", "id", 1, "BIGINT", 5), ("other_one", "a", 1, "VARCHAR", 1), ("other_one", "b", 2, "DOUBLE", 1)]


def test_out_of_order_log_query_has_unique_keys(spark):
    from dimwright.sources.oltp import Oltp

    late = history.late_customers(Oltp(spark, SF))
    assert late.select("CustomerKey").distinct().count() == late.count()
