"""Listing cleaning and questions on the hand-made rows of FIXTURES.md §1."""

import decimal

import pytest
from pyspark.sql import functions as F

from dimwright.operators import profile
from dimwright.plans import listings as L

D = decimal.Decimal
COLS = ("RestaurantID CountryCode City Address Locality LocalityVerbose Cuisines Currency Has_Table_booking "
        "Has_Online_delivery Is_delivering_now Switch_to_order_menu Price_range Votes Average_Cost_for_two Rating")
ROWS = [
    ("1", "1", "Delhi", "A", "X|Indian", "Yes", "YES", "2", "1500", "900", "4.5"),
    ("2", "1", "Delhi", "A", "Indian| Y", "No", "No", "1", "10", "300", "4.4"),
    ("3", "1", "Delhi", "B", None, "yes", "no", "3", "20", "700", "2.5"),
    ("4", "1", "Delhi", "B", "", "no", "yes", "4", "21", "701", "3.5"),
    ("5", "1", "Bras?lia", "C", "X", "No", "No", "1", "0", "0", "0.0"),
    ("6", "30", "Rio", "A", "Z", "No", "No", "1", "5", "50", "3.0"),
    ("7", None, "Rio", "D", "Z", "No", "No", "1", "5", "50", "1.0"),
    ("8", " Bar", "Rio", "D", "Z", "No", "No", "1", "5", "50", "1.0"),
    ("9", "99", "Rio", "D", "Z", "No", "No", "1", "5", "50", "2.4"),
    ("9", "99", "Rio", "D", "Z", "No", "No", "1", "5", "50", "2.4"),
]


@pytest.fixture(scope="module")
def raw(spark):
    full = [
        (r[0], r[1], r[2], "addr", r[3], "verbose", r[4], "INR", r[5], r[6], "No", "No", r[7], r[8], r[9], r[10])
        for r in ROWS
    ]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in COLS.split()))


@pytest.fixture(scope="module")
def country(spark):
    return spark.createDataFrame([("1", "India"), ("30", "Brazil")], "COUNTRYCODE string, COUNTRY string")


@pytest.fixture(scope="module")
def clean(raw, country):
    return L.clean_listings(raw, country).cache()


def test_bad_rows_removed_null_code_kept(clean):
    ids = sorted(r.RestaurantID for r in clean.collect())
    assert ids == ["1", "2", "3", "4", "5", "6", "7", "9", "9"]


def test_country_lookup(clean):
    got = {r.RestaurantID: r.COUNTRY_NAME for r in clean.collect()}
    assert got["1"] == "India" and got["6"] == "Brazil" and got["7"] is None and got["9"] is None


def test_city_repair_and_drops(clean):
    assert "Brasilia" in {r.City for r in clean.collect()}
    for c in L.DROPPED_COLUMNS:
        assert c not in clean.columns


def test_retype_and_bands(clean):
    got = {r.RestaurantID: (r.Rating, r.RATE_CATEGORY) for r in clean.collect()}
    assert got["1"] == (D("4.5"), "EXCELLENT")
    assert got["2"] == (D("4.4"), "GREAT")
    assert got["3"] == (D("2.5"), "GOOD")
    assert got["5"] == (D("0.0"), None)
    assert dict(clean.dtypes)["Votes"] == "int"


def test_legacy_rounding_bands(raw, country):
    legacy = L.clean_listings(raw, country, legacy_rounding=True)
    got = {r.RestaurantID: (r.Rating, r.RATE_CATEGORY) for r in legacy.collect()}
    assert got["1"] == (D("5"), "EXCELLENT")  # 4.5 rounds to 5
    assert got["2"] == (D("4"), "GREAT")


def test_votes_integer_average(clean):
    sub = clean.filter(F.col("RestaurantID").isin("2", "3", "6"))  # 10, 20, 5 -> 11
    assert profile.int_stats(sub, "Votes", "VT").first()["AVG_VT"] == 11


def test_duplicate_key_counts(raw):
    got = {r.RestaurantID: r.N for r in profile.dup_key_counts(raw, "RestaurantID").collect()}
    assert got["9"] == 2 and got["1"] == 1


def test_blank_counts_null_group_is_zero(raw):
    got = {r.Cuisines: r.N for r in profile.blank_counts(raw, "Cuisines").collect()}
    assert got == {None: 0, "": 1}


def test_busiest_locality_tie_kept(clean):
    got = sorted((r.City, r.Locality, r.REST_COUNT) for r in L.busiest_locality(clean, "india").collect())
    assert got == [("Delhi", "A", 2), ("Delhi", "B", 2)]


def test_quietest_locality(clean):
    got = [(r.Locality, r.REST_COUNT) for r in L.quietest_localities(clean, "india").collect()]
    assert got == [("C", 1)]


def test_winner_rows_join_on_full_location(clean):
    # locality 'A' also exists in Brazil (row 6): it must not leak in
    ids = sorted(r.RestaurantID for r in L.winner_rows(clean, "india").collect())
    assert ids == ["1", "2", "3", "4"]


def test_cuisine_counts_untrimmed_parts(clean):
    got = {r.Cuisines: r.N for r in L.busiest_locality_cuisines(clean, "india").collect()}
    assert got == {"X": 1, "Indian": 2, " Y": 1, "": 1}


def test_best_moderate_cost_both_modes(raw, country):
    params = dict(max_price=3, min_votes=1000, max_cost=1000.0, min_rating=4.0, cuisine="%india%")
    got = [r.RestaurantID for r in L.best_moderate_cost(L.clean_listings(raw, country), "india", **params).collect()]
    assert got == ["1"]
    legacy = L.clean_listings(raw, country, legacy_rounding=True)
    assert [r.RestaurantID for r in L.best_moderate_cost(legacy, "india", **params).collect()] == ["1"]


def test_shares(clean):
    got = {r.COUNTRY_NAME: (r.REST_COUNT, r.PCT) for r in L.country_share(clean).collect()}
    # 9 rows in the total (null country included), India 5, Brazil 1
    assert got == {"India": (5, D("55.56")), "Brazil": (1, D("11.11"))}
    online = {r.COUNTRY_NAME: (r.TOTAL_REST, r.PCT) for r in L.online_share(clean).collect()}
    assert online == {"India": (2, D("40.00"))}


def test_running_total_last_equals_city_total(clean):
    rows = L.running_listings(clean, "india").collect()
    for city in {r.City for r in rows}:
        mine = [r for r in rows if r.City == city]
        assert max(r.ROLL_COUNT for r in mine) == sum(r.TOTAL_REST for r in mine)


def test_booking_vs_rating_keeps_empty_branch(clean):
    got = {r.TABLE_BOOKING_OPT: (r.TOTAL_REST, r.AVG_RATING) for r in L.booking_vs_rating(clean, "A").collect()}
    assert got == {"WITH_TABLE": (1, D("4.50")), "WITHOUT_TABLE": (2, D("3.70"))}


def test_d15_running_total_partitioned_by_country_and_city(spark):
    """The same city name in two countries keeps two separate running totals."""
    rows = [("1", "India", "Goa", "A", "5"), ("2", "India", "Goa", "B", "5"),
            ("3", "Peru", "Goa", "A", "5")]
    df = spark.createDataFrame(rows, "RestaurantID string, COUNTRY_NAME string, City string, Locality string, "
                                     "Votes string")
    got = {}
    for country in ("india", "peru"):
        for r in L.running_listings(df, country).collect():
            got[(r.COUNTRY_NAME, r.Locality)] = r.ROLL_COUNT
    assert got == {("India", "B"): 1, ("India", "A"): 2, ("Peru", "A"): 1}
