"""Digests of members, the summary kept by parts, misspelt values, and the busiest groups by a sketch."""

import datetime as dt
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimwright.operators import digests, heavy, spelling
from dimwright.operators.load import Mart, as_key
from dimwright.plans import mart as M
from test_mart import executed_plan, first_dates, small_source

MEMBER = "name string, cat string, tier string"


def tuples(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=str)


# -- digests -----------------------------------------------------------------------
def changes(spark, before, now, as_compared=True):
    frames = [spark.createDataFrame(x, MEMBER) for x in (before, now)]
    diff = digests.digest_diff(*[digests.member_digests(f, ["name"], ["cat", "tier"], as_compared) for f in frames])
    named = frames[0].select("name").unionByName(frames[1].select("name"))
    named = digests.with_key_digest(named.select(F.lower(F.rtrim("name")).alias("name")).distinct(), ["name"])
    return {r.name: r.CHANGE for r in named.join(diff, digests.KEY_DIGEST).collect()}


def test_digest_diff(spark):
    before = [("a", "x", "1"), ("b", None, "1"), ("c", "x", None), ("d", "x", "1"), ("e", "x", "1"), ("e", "y", "1"),
              ("f", "x", "1"), ("f", "x", "1"), (None, "x", "1")]
    now = [("A ", "X", "1 "), ("b", "1", None), ("c", None, "x"), ("e", "y", "1"), ("e", "x", "1"), ("f", "x", "1"),
           ("g", "x", "1"), (None, "y", "1")]
    assert changes(spark, before, now) == {"b": "changed", "c": "changed", "d": "gone", "g": "new"}
    # For type 1 spelling counts.
    assert changes(spark, before, now, as_compared=False)["a"] == "changed"
    assert changes(spark, [], before) == {n: "new" for n in "abcdef"} and changes(spark, before, before) == {}
    assert changes(spark, [("e", "x", "1"), ("e", "y", "1")], [("e", "x", "1"), ("e", "z", "1")]) == {"e": "changed"}


def test_an_unchanged_source_shuffles_digests_only(spark):
    rows = spark.range(500).select(
        F.concat(F.lit("n"), "id").alias("name"), F.lit("c").alias("cat"), F.lit("long text").alias("tier"))
    one, two = (digests.member_digests(rows, ["name"], ["cat", "tier"]) for _ in range(2))
    plan = executed_plan(digests.digest_diff(one, two)).split("== Initial Plan ==")[0]
    assert "Exchange hashpartitioning(_k1" in plan
    assert not any("Exchange" in ln and ("tier" in ln or "name" in ln) for ln in plan.splitlines())


def test_runs_by_digests_equal_runs_over_all_members(spark, monkeypatch):
    src = small_source(spark)
    a, b = first_dates(src, 2)
    fixed = small_source(spark, fix={1: "FIXED", 2: "FIXED", 7: "FIXED"})
    less = small_source(spark, fix={1: "FIXED"})

    def load():
        mart = Mart(spark)
        for day, source in ((a, src), (b, fixed), (b, less)):  # the last one corrects its day
            M.run_dates(source, mart, day, day)
        return [tuples(mart.read(s.name)) for s in M.SPEC_BY_DIM.values()], mart

    by_digest, mart = load()
    assert any("FIXED" in r for r in by_digest[2])
    # Nothing changed: no new version of anything.
    versions = dict(mart._versions)
    M.run_dates(less, mart, b, b)
    assert {t: v for t, v in mart._versions.items() if t.startswith(("dim", "digest"))} == {
        t: v for t, v in versions.items() if t.startswith(("dim", "digest"))}
    monkeypatch.setattr(M, "_digest_table", lambda spec: f"none_{spec.name}_{random.random()}")
    assert load()[0] == by_digest


# -- the kept summary -----------------------------------------------------------------
def test_kept_summary_after_any_series_of_loads(spark):
    src = small_source(spark)
    a, b, c, d = first_dates(src, 4)
    mart = Mart(spark)
    for source, start, end in ((src, a, c), (small_source(spark, without={b}), b, c), (src, c, d)):
        M.run_dates(source, mart, start, end, keep_summary=True)
        want = M.mart_summary(mart.read_fact(), mart.read(M.CUSTOMERS.name), mart.read("dim_date"))
        assert tuples(M.kept_summary(mart)) == tuples(want)
    M.run_dates(src, mart, d, d)  # without its part
    with pytest.raises(ValueError):
        M.kept_summary(mart)


def test_parts_of_old_loads_are_not_read(spark):
    src = small_source(spark)
    a, b = first_dates(src, 2)
    mart = Mart(spark)
    for _ in range(2):
        M.run_dates(src, mart, a, b, keep_summary=True)
    plan = executed_plan(mart.read_parts(M.SALES))
    assert "dynamicpruning" in plan and {r.run for r in mart.fact_index(as_key(a), as_key(b)).collect()} == {2}


# -- misspelt values ---------------------------------------------------------------------
def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_misspellings(values, edits, ratio, min_length):
    counts = Counter(v for v in values if v is not None and len(v) >= min_length)
    out = []
    for s, n in counts.items():
        near = [(-m, distance(s, t), t) for t, m in counts.items() if t != s and m >= ratio * n and distance(s, t) <= edits]
        if near:
            m, e, t = min(near)
            out.append((s, n, t, -m, e))
    return sorted(out, key=str)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.text("abc", max_size=7), st.sampled_from(["paris", "pariss", "prais", "lyon é", None])),
                min_size=1, max_size=60), st.sampled_from([1, 2]))
def test_misspellings_equal_all_pairs(spark, values, edits):
    df = spark.createDataFrame([(v,) for v in values], "city string")
    got = spelling.misspellings(df, "city", edits, ratio=2, min_length=3)
    assert tuples(got) == brute_misspellings(values, edits, 2, 3)


def test_planted_misspellings_are_corrected(spark):
    rng = random.Random(8)
    cities = ["Springfield", "Riverdale", "Mountain View", "São Paulo", "New Haven"]
    values, want = [], []
    for n in range(2000):
        city = rng.choice(cities)
        at = rng.randrange(1, len(city))
        wrong = rng.choice([city[:at] + city[at + 1 :], city[:at] + "?" + city[at + 1 :], city[:at] + "~" + city[at:]])
        values.append(wrong if n % 50 == 0 else city)
        want.append(city)
    df = spark.createDataFrame(list(zip(range(2000), values)), "id int, city string")
    found = spelling.misspellings(df, "city")
    fixed = spelling.corrected(df, "city", found)
    assert fixed.columns == ["id", "city"]
    assert [r.city for r in fixed.orderBy("id").collect()] == want
    assert "Cartesian" not in executed_plan(found) and "NestedLoop" not in executed_plan(found)


# -- busiest groups ---------------------------------------------------------------------------
@pytest.mark.parametrize("counters", [2, 8, 1000])
def test_busiest_groups_are_exact(spark, counters):
    """With few counters nothing is proven and all groups are counted; ties and null keys included."""
    rng = random.Random(counters)
    rows = [(rng.choice("abcdef"), rng.choice([1, 2, None])) for _ in range(800)]
    rows += [("hot", None)] * 300 + [(None, None)] * 300 + [("null", 7)] * 299
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "a string, b int").repartition(5)
    counts = Counter(rows)
    best = max(counts.values())
    want = sorted(((*k, n) for k, n in counts.items() if n == best), key=str)
    assert len(want) == 2
    assert tuples(heavy.busiest_groups(df, ["a", "b"], "n", counters)) == want
    assert heavy.busiest_groups(df.limit(0), ["a", "b"], "n", counters).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=80), max_size=6), st.integers(1, 10))
def test_sketch_bounds(parts, counters):
    total, error = Counter(), 0
    for part in parts:
        sketch = heavy.Sketch(counters)
        for x in part:
            sketch.add({x: 1})
        sketch.shrink()
        assert len(sketch.counts) <= counters
        total.update(sketch.counts)
        error += sketch.error
    true = Counter(x for part in parts for x in part)
    for k, n in true.items():
        assert total[k] <= n <= total[k] + error


def test_winners_do_not_shuffle_every_group(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("g"))
    got = heavy.busiest_groups(df, ["g"], "n", counters=64)
    assert [tuple(r) for r in got.collect()] == [("hot", 20_000)]
    assert "LeftSemi" in executed_plan(got)


# -- members that arrive late --------------------------------------------------------------------
def test_only_dates_of_late_members_are_built_anew(spark):
    """Three days with orders of customers that are entered later: only days that name them are loaded again."""
    src = small_source(spark)
    days = first_dates(src, 4)
    orders = src.orders(days[0], days[2]).select("OrderDate", "CustomerID").collect()
    missing = [r.CustomerID for r in orders if r.OrderDate == days[1]][:2]

    class Early(type(src)):
        @property
        def customers(self):
            return src.customers.where(~F.col("CustomerID").isin(missing))

    mart = Mart(spark)
    for day in days[:3]:
        M.run_dates(Early(spark, src.sf_dir), mart, day, day, late_members=True)
    named = {as_key(r.OrderDate) for r in orders if r.CustomerID in missing}
    unknown = {r.DateKey for r in mart.read_fact().where("CustomerKey = -1").select("DateKey").distinct().collect()}
    assert unknown and unknown <= named
    M.run_dates(src, mart, days[3], days[3], late_members=True)
    assert mart.read_fact().where("CustomerKey = -1").count() == 0
    runs = {r.DateKey: r.run for r in mart.fact_index().collect()}
    assert {k for k, run in runs.items() if run == 4} == named | {as_key(days[3])}
    assert mart.read_parts(M.UNRESOLVED).count() == 0
