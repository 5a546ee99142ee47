"""SQL-semantics helpers, one test per M-number of SURVEY §1.4."""

import decimal

from pyspark.sql import functions as F

from dimwright.functions.semantics import (
    any_changed, eq_ci, int_avg, is_null_or_blank, keep_unless, percentage, round_ratio, to_whole_decimal,
)
from dimwright.operators.joins import lateral_split
from dimwright.operators.grouped import running_total
from dimwright.plans.listings import rating_band, update_from_lookup

D = decimal.Decimal


def test_m1_case_insensitive_equality(spark):
    df = spark.createDataFrame([("India",), ("INDIA",), ("india ",), (None,)], "c string")
    assert df.filter(eq_ci("c", "INDIA")).count() == 2


def test_m2_blank_ignores_trailing_spaces(spark):
    df = spark.createDataFrame([("",), (" ",), ("  ",), ("a ",), (None,)], "c string")
    assert df.filter(is_null_or_blank("c")).count() == 4


def test_m3_integer_average_truncates(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "v int")
    assert df.agg(int_avg("v").alias("a")).first()["a"] == 1


def test_m4_bare_decimal_rounds_half_up(spark):
    df = spark.createDataFrame([("4.5",), ("4.4",), ("0.5",), ("2.5",)], "r string")
    out = [r[0] for r in df.select(to_whole_decimal(F.col("r").cast("decimal(3,1)"))).collect()]
    assert out == [D(5), D(4), D(1), D(3)]


def test_m6_m7_exact_half_up_ratio(spark):
    # 41 / 20 = 2.05 exactly: half-up gives 2.1 (a binary double would give 2.0 or 2.1)
    df = spark.createDataFrame([(41, 20), (1, 3), (2, 3), (-41, 20), (5, 0)], "n long, d long")
    out = [r[0] for r in df.select(round_ratio(F.col("n"), F.col("d"), 1)).collect()]
    assert out == [D("2.1"), D("0.3"), D("0.7"), D("-2.1"), None]


def test_percentage_two_decimals(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8)], "a long, b long")
    out = [r[0] for r in df.select(percentage(F.col("a"), F.col("b"))).collect()]
    assert out == [D("33.33"), D("66.67"), D("12.50")]


def test_m9_count_column_skips_nulls(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "c string")
    got = {r["c"]: r["n"] for r in df.groupBy("c").agg(F.count("c").alias("n")).collect()}
    assert got == {None: 0, "a": 1}


def test_m10_delete_keeps_unknown(spark):
    df = spark.createDataFrame([("1",), (" Bar",), (None,)], "c string")
    kept = df.filter(keep_unless(F.col("c").isin(" Bar"))).collect()
    assert {r.c for r in kept} == {"1", None}


def test_m11_null_safe_change_detection(spark):
    df = spark.createDataFrame([(None, "x"), ("x", "x"), (None, None)], "a string, b string")
    safe = [r[0] for r in df.select(any_changed([(F.col("a"), F.col("b"))])).collect()]
    legacy = [r[0] for r in df.select(any_changed([(F.col("a"), F.col("b"))], null_safe=False)).collect()]
    assert safe == [True, False, False]
    assert legacy == [False, False, False]


def test_m12_band_without_else_is_null(spark):
    df = spark.createDataFrame([(D("0.9"),), (D("1.0"),), (D("2.5"),), (D("3.5"),), (D("4.5"),), (None,)],
                               "r decimal(3,1)")
    out = [r[0] for r in df.select(rating_band("r")).collect()]
    assert out == [None, "POOR", "GOOD", "GREAT", "EXCELLENT", None]


def test_m14_running_total_includes_peers(spark):
    df = spark.createDataFrame([("c", "a", 1), ("c", "a", 2), ("c", "b", 4)], "city string, loc string, n long")
    out = running_total(df, ["city"], [F.col("loc")], "n", "run").orderBy("loc", "n").collect()
    assert [r.run for r in out] == [3, 3, 7]


def test_m16_split_semantics(spark):
    df = spark.createDataFrame([(1, "X|Indian"), (2, "Indian| Y"), (3, None), (4, "")], "id int, c string")
    parts = lateral_split(df, "c", "|").groupBy("id").agg(F.collect_list("c").alias("p"))
    got = {r.id: sorted(r.p) for r in parts.collect()}
    assert got == {1: ["Indian", "X"], 2: [" Y", "Indian"], 4: [""]}


def test_m17_lookup_unmatched_stays_null_and_no_fanout(spark):
    df = spark.createDataFrame([("1",), ("99",), (None,)], "code string").withColumn("name", F.lit(None).cast("string"))
    lk = spark.createDataFrame([("1", "India"), ("1", "Bharat"), ("30", "Brazil")], "COUNTRYCODE string, COUNTRY string")
    out = update_from_lookup(df, lk, "code", "COUNTRYCODE", "COUNTRY", "name").collect()
    assert len(out) == 3
    assert {r.code: r.name for r in out} == {"1": "Bharat", "99": None, None: None}


def test_window_is_partitioned(spark):
    """A running total must not pull all rows into one partition."""
    df = spark.createDataFrame([("c", "a", 1)], "city string, loc string, n long")
    plan = running_total(df, ["city"], [F.col("loc")], "n", "run")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

keys = st.one_of(st.none(), st.integers(min_value=0, max_value=6))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(keys, st.integers(0, 9)), max_size=12),
       st.lists(st.tuples(keys, st.integers(0, 9)), max_size=12))
def test_left_join_small_preserved_equals_left_join(spark, small_rows, big_rows):
    from dimwright.operators.joins import left_join_small_preserved

    small = spark.createDataFrame(small_rows, "k int, a int")
    big = spark.createDataFrame(big_rows, "k int, b int")
    got = sorted(map(tuple, left_join_small_preserved(small, big, "k").select("k", "a", "b").collect()), key=str)
    want = sorted(map(tuple, small.join(big, "k", "left").select("k", "a", "b").collect()), key=str)
    assert got == want


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(keys, st.integers(0, 9)), max_size=12),
       st.lists(st.integers(min_value=0, max_value=6), max_size=6, unique=True))
def test_spread_joins_equal_left_join(spark, fact_rows, dim_keys):
    """Scattering null keys over a second join column changes no row, also for keys of different integer types."""
    from dimwright.operators.joins import key_lookup, left_join_spread

    facts = spark.createDataFrame(fact_rows, "k int, v int")
    dim = spark.createDataFrame([(k, k * 10) for k in dim_keys], "k long, sk int")
    want = sorted(map(tuple, facts.join(dim, "k", "left").select("k", "v", "sk").collect()), key=str)
    spread = left_join_spread(facts, dim, "k", by="v")
    assert sorted(map(tuple, spread.select(facts["k"], "v", "sk").collect()), key=str) == want
    looked_up = key_lookup(facts, dim, ["k"], ["k"], {"sk": "SK"})
    assert sorted(map(tuple, looked_up.select("k", "v", "SK").collect()), key=str) == want


def test_business_keys_ignore_case_and_trailing_blanks(spark):
    from dimwright.operators.joins import key_lookup

    facts = spark.createDataFrame([("ACME ",), ("acme",), (" acme",), (None,)], "n string")
    dim = spark.createDataFrame([("Acme", 7)], "name string, sk int")
    got = {r.n: r.SK for r in key_lookup(facts, dim, ["n"], ["name"], {"sk": "SK"}).collect()}
    assert got == {"ACME ": 7, "acme": 7, " acme": None, None: None}
