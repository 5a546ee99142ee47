"""SCD1/SCD2 and surrogate keys: FIXTURES.md §5 plus properties on random inputs."""

import datetime as dt

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from dimwright.operators.keys import with_dense_keys
from dimwright.operators.scd import scd1, scd2

d = dt.date
DIM_SCHEMA = "k long, name string, cat string, StartDate date, EndDate date"
BEFORE = [
    (1, "a", "x", d(2013, 1, 1), None),
    (2, "b", "x", d(2013, 1, 1), None),
    (3, "c", "x", d(2013, 1, 1), None),
    (4, "d", "x", d(2012, 1, 1), d(2012, 12, 31)),
    (5, "d", "y", d(2013, 1, 1), None),
    (6, "e", "x", d(2012, 1, 1), d(2012, 12, 31)),
    (7, "f", None, d(2013, 1, 1), None),
]
STAGE = [("a", "x"), ("b", "y"), ("d", "y"), ("e", "x"), ("f", "z"), ("g", "x")]
EXPECTED = {
    (1, "a", "x", d(2013, 1, 1), None),
    (2, "b", "x", d(2013, 1, 1), d(2013, 1, 1)),
    (8, "b", "y", d(2013, 1, 2), None),
    (3, "c", "x", d(2013, 1, 1), d(2013, 1, 1)),
    (4, "d", "x", d(2012, 1, 1), d(2012, 12, 31)),
    (5, "d", "y", d(2013, 1, 1), None),
    (6, "e", "x", d(2012, 1, 1), d(2012, 12, 31)),
    (9, "e", "x", d(2013, 1, 2), None),
    (7, "f", None, d(2013, 1, 1), d(2013, 1, 1)),
    (10, "f", "z", d(2013, 1, 2), None),
    (11, "g", "x", d(2013, 1, 2), None),
}
START, END = d(2013, 1, 2), d(2013, 1, 1)


def rows(df):
    return {tuple(r) for r in df.select("k", "name", "cat", "StartDate", "EndDate").collect()}


def run(spark, before, stage, null_safe=True):
    dim = spark.createDataFrame(before, DIM_SCHEMA)
    stg = spark.createDataFrame(stage, "name string, cat string")
    return scd2(stg, dim, "name", ["cat"], "k", START, END, null_safe=null_safe)


def test_scd2_fixture(spark):
    assert rows(run(spark, BEFORE, STAGE)) == EXPECTED


def test_scd2_idempotent(spark):
    once = sorted(rows(run(spark, BEFORE, STAGE)), key=str)
    twice = rows(run(spark, once, STAGE))
    assert twice == set(once)


def test_scd2_legacy_misses_null_change(spark):
    got = rows(run(spark, BEFORE, STAGE, null_safe=False))
    assert (7, "f", None, d(2013, 1, 1), None) in got  # f null -> z not detected
    assert not any(r[1] == "f" and r[2] == "z" for r in got)


def test_scd1_reuses_keys_and_dedupes(spark):
    dim = spark.createDataFrame([(1, "Rome", "IT"), (2, "Oslo", "NO")], "k long, city string, cc string")
    stg = spark.createDataFrame([("Rome", "IT"), ("Rome", "IT"), ("Lima", "PE"), ("Bern", "CH")],
                                "city string, cc string")
    got = {tuple(r) for r in scd1(stg, dim, ["city"], ["cc"], "k").collect()}
    assert got == {(1, "Rome", "IT"), (3, "Bern", "CH"), (4, "Lima", "PE")}


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(min_value=0, max_value=10_000), min_size=0, max_size=120, unique=True),
       st.integers(min_value=1, max_value=7), st.integers(min_value=0, max_value=50))
def test_dense_keys_properties(spark, values, parts, base):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    keyed = with_dense_keys(df, ["v"], "key", base=base, num_partitions=parts).collect()
    got = sorted((r.v, r.key) for r in keyed)
    assert got == [(v, base + i + 1) for i, v in enumerate(sorted(values))]


names = st.sampled_from(list("abcdefgh"))
cats = st.one_of(st.none(), st.sampled_from(["x", "y"]))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(names, cats, max_size=8), st.dictionaries(names, cats, max_size=8))
def test_scd2_properties(spark, first, second):
    """Load two successive stages: one open row per key, no overlapping validity,
    unique keys, history untouched, re-applying the second stage changes nothing."""
    dim0 = spark.createDataFrame([], DIM_SCHEMA)
    s1 = spark.createDataFrame(sorted(first.items()), "name string, cat string")
    s2 = spark.createDataFrame(sorted(second.items()), "name string, cat string")
    v1 = scd2(s1, dim0, "name", ["cat"], "k", d(2013, 1, 1), d(2012, 12, 31)).collect()
    dim1 = spark.createDataFrame([tuple(r) for r in v1], DIM_SCHEMA)
    v2 = scd2(s2, dim1, "name", ["cat"], "k", START, END).collect()
    keys = [r.k for r in v2]
    assert len(keys) == len(set(keys))
    opens = [r.name for r in v2 if r.EndDate is None]
    assert len(opens) == len(set(opens)) and set(opens) == set(second)
    for n in set(r.name for r in v2):
        spans = sorted((r.StartDate, r.EndDate or d(9999, 12, 31)) for r in v2 if r.name == n)
        for (s_a, e_a), (s_b, _) in zip(spans, spans[1:]):
            assert e_a < s_b
    assert {tuple(r) for r in v1 if r.EndDate is not None} <= {tuple(r) for r in v2}
    dim2 = spark.createDataFrame([tuple(r) for r in v2], DIM_SCHEMA)
    v3 = scd2(s2, dim2, "name", ["cat"], "k", START, END).collect()
    assert {tuple(r) for r in v3} == {tuple(r) for r in v2}


def test_scd2_change_report(spark):
    dim = spark.createDataFrame(BEFORE, DIM_SCHEMA)
    stg = spark.createDataFrame(STAGE, "name string, cat string")
    report = {}
    after = scd2(stg, dim, "name", ["cat"], "k", START, END, report=report)
    assert report == {"changed": True}
    again = {}
    scd2(stg, spark.createDataFrame([tuple(r) for r in after.collect()], DIM_SCHEMA), "name", ["cat"], "k",
         START, END, report=again)
    assert again == {"changed": False}


def test_key_spelling_and_null_keys(spark):
    """Other case and trailing blanks are the same member; a null key is no member; neither churns."""
    dim = spark.createDataFrame([(1, "Acme", "x", d(2013, 1, 1), None)], DIM_SCHEMA)
    stg = spark.createDataFrame([("ACME ", "X "), (None, "y"), (None, "z")], "name string, cat string")
    report = {}
    after = scd2(stg, dim, "name", ["cat"], "k", START, END, report=report)
    assert rows(after) == {(1, "Acme", "x", d(2013, 1, 1), None)} and report == {"changed": False}
    cities = spark.createDataFrame([(1, "Rome", "IT")], "k long, city string, cc string")
    stage = spark.createDataFrame([("ROME", "IT"), ("rome ", "IT"), (None, "??")], "city string, cc string")
    got = scd1(stage, cities, ["city"], ["cc"], "k").collect()
    assert [(r.k, r.cc) for r in got] == [(1, "IT")]


def test_backdated_run_is_refused(spark):
    import pytest

    from dimwright.operators.scd import BackdatedRunError

    with pytest.raises(BackdatedRunError):
        scd2(spark.createDataFrame(STAGE, "name string, cat string"), spark.createDataFrame(BEFORE, DIM_SCHEMA),
             "name", ["cat"], "k", d(2012, 6, 1), d(2012, 5, 31))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.dictionaries(names, cats, max_size=6)), min_size=1, max_size=4))
def test_scd2_any_sequence_of_dates(spark, runs):
    """Runs on random dates, repeats included: valid intervals, no overlap, at most one open row, older runs refused."""
    from dimwright.operators.scd import BackdatedRunError

    dim, newest = [], -1
    for offset, members in runs:
        day = d(2013, 1, 1) + dt.timedelta(days=offset)
        stg = spark.createDataFrame(sorted(members.items()), "name string, cat string")
        try:
            after = scd2(stg, spark.createDataFrame(dim, DIM_SCHEMA), "name", ["cat"], "k", day,
                         day - dt.timedelta(days=1)).collect()
        except BackdatedRunError:
            assert offset < newest
            continue
        dim, newest = [tuple(r) for r in after], max(newest, offset)
        assert {r[1] for r in dim if r[4] is None} == set(members)
        assert all(r[4] is None or r[3] <= r[4] for r in dim)
        for n in {r[1] for r in dim}:
            spans = sorted((r[3], r[4] or d(9999, 12, 31)) for r in dim if r[1] == n)
            assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
