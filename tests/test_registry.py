"""Registry contract, SQL-oracle agreement at sf0.001, and plan assertions."""

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

SF = "/root/testdata/sf0.001"
# Keys whose result is a written table: checked by test_mart and the sf0.01 oracle run instead.
SLOW_SINKS = {"append_fact", "load_fact", "daily_run"}


def core_queries():
    from dimwright.plans.catalog import QUERIES

    return QUERIES


def test_every_key_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries

    assert set(core_queries()) <= set(queries())
    assert set(core_queries()) <= set(oracle_sql())
    assert len(core_queries()) == 147


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert "REVENUE" in df.columns


@pytest.fixture(scope="module")
def duck():
    from oracle_check import duck as make

    return make(SF)


def _keys():
    return [k for k in core_queries() if k not in SLOW_SINKS]


@pytest.mark.parametrize("key", _keys())
def test_matches_oracle(spark, duck, key):
    from oracle_check import rows_key
    from __spark_entry__ import oracle_sql, queries

    df = queries()[key](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[key])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_key(df.columns, s_rows) == rows_key(d_cols, d_rows)


def _plan(df) -> str:
    """The plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()


def _executed(df) -> str:
    """The final adaptive plan of ``df`` itself, after running it."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


def test_date_slice_is_pushed_to_the_scan(spark):
    from dimwright.plans import extract as ex
    from dimwright.sources.oltp import Oltp

    plan = _plan(ex.extract_orders(Oltp(spark, SF), dt.date(1995, 1, 1), dt.date(1995, 1, 1)))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_listing_scan_is_pruned(spark):
    from __spark_entry__ import queries

    # The running count never uses Votes: Catalyst drops the lineitem join.
    plan = _plan(queries()["running_listings"](spark, SF))
    assert "lineitem" not in plan
    assert "SinglePartition" not in plan
    # The cleaned listing reads one lineitem column, for the vote count.
    assert "ReadSchema: struct<l_partkey:bigint>" in _plan(queries()["clean_listings"](spark, SF))


def test_fact_lookups_are_broadcast(spark):
    from dimwright.plans import mart as M
    from dimwright.plans import extract as ex
    from dimwright.sources.oltp import Oltp

    src = Oltp(spark, SF)
    dims = M.build_dimensions(src, M.first_order_date(src))
    plan = _plan(M.fact_orders(ex.extract_orders(src), dims))
    assert plan.count("BroadcastHashJoin") >= 5


def test_surrogate_keys_never_single_partition_over_rows(spark):
    from dimwright.operators.keys import with_dense_keys

    df = spark.range(1000).withColumnRenamed("id", "v")
    plan = _plan(with_dense_keys(df, ["v"], "k"))
    # the only unpartitioned window runs over one row per partition (the offsets)
    assert "RowNumber" not in plan


def test_results_do_not_depend_on_session_time_zone(spark):
    from __spark_entry__ import queries

    keys = ("extract_date_slice", "fn_date_parts", "dim_date")
    base = {k: sorted(map(tuple, queries()[k](spark, SF).collect())) for k in keys}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
        for k in keys:
            assert sorted(map(tuple, queries()[k](spark, SF).collect())) == base[k], k
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("key", ["running_listings", "country_share", "busiest_locality_cuisines",
                                 "quietest_localities", "scd2_customers", "fact_orders", "dq_orphan_keys",
                                 "grand_total_window", "surrogate_keys"])
def test_single_partition_exchanges_only_over_aggregates(spark, key):
    """No plan moves unaggregated rows into one task: the child of every
    SinglePartition exchange is a (partial) aggregate."""
    from __spark_entry__ import queries

    plan = _executed(queries()[key](spark, SF))
    assert "isFinalPlan=false" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next(ln for ln in lines[i + 1:] if "WholeStageCodegen" not in ln and "InputAdapter" not in ln)
            assert "Aggregate" in below, f"{key}: {line.strip()} over {below.strip()}"


def test_country_shares_sum_to_100(spark):
    from decimal import Decimal

    from __spark_entry__ import queries

    rows = queries()["country_share"](spark, "/root/testdata/sf0.01").collect()
    total = sum(r.PCT for r in rows)
    assert abs(total - Decimal(100)) <= Decimal("0.01") * len(rows)


def test_one_day_extract_does_not_shuffle_order_lines(spark):
    from dimwright.plans import extract as ex
    from dimwright.plans import mart as M
    from dimwright.sources.oltp import Oltp

    src = Oltp(spark, SF)
    d0 = M.first_order_date(src)
    plan = _executed(ex.extract_orders(src, d0, d0)).split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    # lineitem streams through a semi join against the broadcast order keys
    semi = [i for i, ln in enumerate(lines) if "LeftSemi, BuildRight" in ln]
    assert semi, plan
    assert not any("Exchange hashpartitioning" in ln and "l_orderkey" in ln for ln in lines)
    assert not any("BroadcastExchange" in lines[i] and "l_orderkey" in lines[i + 1]
                   for i in range(len(lines) - 1))


ORDERED = {
    # query: sort columns, True for descending
    "sort_desc": [("N", True), ("Currency", False)],
    "sort_mixed": [("COUNTRY_NAME", False), ("City", False), ("TOTAL_REST", True)],
    "sort_by_name": [("City", False), ("Locality", False)],
    "country_share": [("PCT", True), ("COUNTRY_NAME", False)],
    "listings_per_country": [("REST_COUNT", True), ("COUNTRY_NAME", False)],
    "online_share": [("TOTAL_REST", True), ("COUNTRY_NAME", False)],
    "busiest_locality_cuisines": [("N", True), ("Cuisines", False)],
    "quietest_localities": [("City", False), ("Locality", False)],
    "location_ratings": [("TOTAL_REST", True), ("COUNTRY_NAME", False), ("City", False), ("Locality", False)],
}


@pytest.mark.parametrize("key", sorted(ORDERED))
def test_result_order(spark, key):
    rows = core_queries()[key](spark, SF).collect()
    want = list(rows)
    for column, descending in reversed(ORDERED[key]):
        # nulls sort first ascending, last descending, as in Spark
        want.sort(key=lambda r: (r[column] is not None, r[column] if r[column] is not None else 0), reverse=descending)
    assert [tuple(r) for r in rows] == [tuple(r) for r in want]


def test_building_a_fact_runs_few_jobs(spark):
    """No size checks while the plan is built: jobs are the key numberings (three small ones per dimension)."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-building", "fact_orders")
    try:
        core_queries()["extract_orders"](spark, SF)
        assert len(tracker.getJobIdsForGroup("plan-building")) <= 12  # schema reads of the source tables
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
