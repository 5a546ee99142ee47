"""Listing cleaning and the business questions over the cleaned listing.

``clean_listings`` is one lazy chain - filter, broadcast lookup join, column
repairs, drops, casts, banding - that Spark runs as a single stage over the
listing with no shuffle of its own.  The questions are group counts, a
windowed running total, arg-max/min groups and shares; every one runs on the
whole listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.functions.semantics import (
    avg_rounded,
    contains_literal,
    eq_ci,
    keep_unless,
    like_ci,
    to_whole_decimal,
)
from dimwright.operators import grouped
from dimwright.operators.joins import lateral_split

# Fixed values from the reference's cleaning script (they must match exactly):
# country codes that are fragments of misparsed rows, and one bad listing id.
JUNK_COUNTRY_CODES = (" Bar", " Grill", ' Bakers & More"', ' Chowringhee Lane"', ' Grill & Bar"', " Chinese")
BAD_RESTAURANT_ID = "18306543"
# Rating bands: [1, 2.5) POOR, [2.5, 3.5) GOOD, [3.5, 4.5) GREAT, >= 4.5 EXCELLENT.
RATING_BANDS = ((1.0, 2.5, "POOR"), (2.5, 3.5, "GOOD"), (3.5, 4.5, "GREAT"), (4.5, None, "EXCELLENT"))
DROPPED_COLUMNS = ("Address", "LocalityVerbose", "Switch_to_order_menu")

# Defaults that map the reference's constants onto the driver's tables:
# its country ('INDIA') is region 'ASIA' and its locality ('Connaught Place')
# is brand 'Brand#2'.
HOME_COUNTRY = "Asia"
FOCUS_LOCALITY = "Brand#2"


# -- cleaning -----------------------------------------------------------------
def remove_in_list(df: DataFrame, column: str, values) -> DataFrame:
    """DELETE WHERE column IN (...): rows with a null value are kept."""
    return df.filter(keep_unless(F.col(column).isin(list(values))))


def remove_by_key(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(keep_unless(F.col(column) == F.lit(value)))


def unique_lookup(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """One row per lookup key (smallest value wins), so a join cannot fan out."""
    return lookup.groupBy(key).agg(F.min(value).alias(value))


def update_from_lookup(df: DataFrame, lookup: DataFrame, df_key: str, lookup_key: str,
                       lookup_value: str, target: str) -> DataFrame:
    """UPDATE ... SET target = lookup.value FROM df JOIN lookup: unmatched rows keep
    the current value (null for a freshly added column)."""
    # Internal names: Spark resolves names case-insensitively, and lookup
    # columns such as COUNTRYCODE would collide with CountryCode.
    small = unique_lookup(
        lookup.select(F.col(lookup_key).alias("_lookup_key"), F.col(lookup_value).alias("_lookup_value")),
        "_lookup_key", "_lookup_value",
    )
    joined = df.join(small, df[df_key] == small["_lookup_key"], "left")
    current = F.col(target) if target in df.columns else F.lit(None).cast("string")
    return joined.withColumn(target, F.coalesce(F.col("_lookup_value"), current)).drop("_lookup_key", "_lookup_value")


def rating_band(rating) -> F.Column:
    """CASE without ELSE: ratings below 1 (and null) get no band."""
    r = F.col(rating) if isinstance(rating, str) else rating
    expr = None
    for lo, hi, name in RATING_BANDS:
        cond = r >= F.lit(lo) if hi is None else (r >= F.lit(lo)) & (r < F.lit(hi))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def repair_city(df: DataFrame) -> DataFrame:
    """UPDATE SET City = REPLACE(City, '?', 'i') WHERE City LIKE '%?%'."""
    fixed = F.replace(F.col("City"), F.lit("?"), F.lit("i"))
    return df.withColumn("City", F.when(contains_literal("City", "?"), fixed).otherwise(F.col("City")))


def retype(df: DataFrame, legacy_rounding: bool = False) -> DataFrame:
    """Votes INT, Price_range INT, Average_Cost_for_two DOUBLE, Rating DECIMAL.

    Rating keeps one decimal; ``legacy_rounding`` reproduces the reference's
    bare DECIMAL, which rounds ratings to whole numbers.
    """
    rating_type = "decimal(18,0)" if legacy_rounding else "decimal(3,1)"
    return df.withColumns({
        "Votes": F.col("Votes").cast("int"),
        "Price_range": F.col("Price_range").cast("int"),
        "Average_Cost_for_two": F.col("Average_Cost_for_two").cast("double"),
        "Rating": F.col("Rating").cast(rating_type),
    })


def clean_listings(raw: DataFrame, country: DataFrame, legacy_rounding: bool = False) -> DataFrame:
    df = remove_in_list(raw, "CountryCode", JUNK_COUNTRY_CODES)
    df = remove_by_key(df, "RestaurantID", BAD_RESTAURANT_ID)
    df = update_from_lookup(df, country, "CountryCode", "COUNTRYCODE", "COUNTRY", "COUNTRY_NAME")
    df = repair_city(df)
    df = df.drop(*DROPPED_COLUMNS)
    df = retype(df, legacy_rounding)
    return df.withColumn("RATE_CATEGORY", rating_band("Rating"))


def with_misspelt_places(listing: DataFrame) -> DataFrame:
    """Place = city and first cuisine, misspelt in some rows: a character gone, two swapped, one unreadable, one too many."""
    place = F.concat_ws(" ", "City", F.substring_index("Cuisines", "|", 1))
    kind = F.col("RestaurantID").cast("long") % 40
    wrong = (
        F.when(kind == 1, F.expr("concat(left(Place, 2), substring(Place, 4))"))
        .when(kind == 2, F.expr("concat(left(Place, 3), substring(Place, 5, 1), substring(Place, 4, 1), substring(Place, 6))"))
        .when(kind == 3, F.expr("concat(left(Place, 1), '?', substring(Place, 3))"))
        .when(kind == 4, F.concat("Place", F.lit("x")))
    )
    return listing.withColumn("Place", place).withColumn("Place", F.coalesce(wrong, "Place"))


# -- questions ----------------------------------------------------------------
def in_country(df: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    return df.filter(eq_ci("COUNTRY_NAME", country))


def misspelled_cities(raw: DataFrame) -> DataFrame:
    """Distinct city spellings holding '?' and their correction."""
    return (
        raw.filter(contains_literal("City", "?"))
        .select("City")
        .distinct()
        .withColumn("CORRECTED", F.replace(F.col("City"), F.lit("?"), F.lit("i")))
    )


def listings_per_city(listing: DataFrame) -> DataFrame:
    return grouped.group_count(listing, ["COUNTRY_NAME", "City"], "City", "TOTAL_REST").orderBy(
        "COUNTRY_NAME", "City", F.desc("TOTAL_REST")
    )


def listings_per_locality(listing: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    """Listings per locality in one country."""
    return grouped.group_count(
        in_country(listing, country), ["COUNTRY_NAME", "City", "Locality"], "Locality", "TOTAL_REST"
    )


def running_listings(listing: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    """Listings per locality in one country, with a running total per
    (country, city) in descending locality order."""
    return grouped.running_total(
        listings_per_locality(listing, country), ["COUNTRY_NAME", "City"], [F.desc("Locality")], "TOTAL_REST", "ROLL_COUNT"
    )


def running_listings_asc(listing: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    """Count per (city, locality) with a running total per city in ascending order."""
    counts = grouped.group_count(in_country(listing, country), ["City", "Locality"], "Locality", "COUNT_LOCALITY")
    return grouped.running_total(
        counts, ["City"], [F.col("City"), F.col("Locality")], "COUNT_LOCALITY", "ROLL_COUNT"
    ).orderBy("City", "Locality", F.desc("COUNT_LOCALITY"))


def _id_numeric():
    return to_whole_decimal("RestaurantID")


def country_share(listing: DataFrame) -> DataFrame:
    return grouped.share_of_total(listing, "COUNTRY_NAME", _id_numeric(), "REST_COUNT", "PCT").orderBy(
        F.desc("PCT"), "COUNTRY_NAME")


def listings_per_country(listing: DataFrame) -> DataFrame:
    return listing.groupBy("COUNTRY_NAME").agg(F.count(_id_numeric()).alias("REST_COUNT")).orderBy(
        F.desc("REST_COUNT"), "COUNTRY_NAME"
    )


def online_share(listing: DataFrame) -> DataFrame:
    return grouped.share_within_group(
        listing, "COUNTRY_NAME", eq_ci("Has_Online_delivery", "yes"), F.col("RestaurantID"),
        "TOTAL_REST", "PCT",
    ).orderBy(F.desc("TOTAL_REST"), "COUNTRY_NAME")


def locality_counts(listing: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    """REST_COUNT per (country, city, locality) inside one country."""
    return grouped.group_count(
        in_country(listing, country), ["COUNTRY_NAME", "City", "Locality"], "RestaurantID", "REST_COUNT"
    )


def busiest_locality(listing: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    return grouped.argmax_groups(locality_counts(listing, country), "REST_COUNT").select(
        "City", "Locality", "REST_COUNT"
    )


def quietest_localities(listing: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    return grouped.argmin_groups(locality_counts(listing, country), "REST_COUNT").select(
        "City", "Locality", "REST_COUNT"
    ).orderBy("City", "Locality")


def winner_rows(listing: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    """Listing rows of the busiest locality (or localities, on a tie).

    Joined on (country, city, locality), so a homonymous locality elsewhere
    does not leak in.  The winners are usually a handful of rows, but ties are
    data-dependent (uniform counts make every group a winner), so how they are
    joined is left to AQE.
    """
    keys = ["COUNTRY_NAME", "City", "Locality"]
    winners = grouped.argmax_groups(locality_counts(listing, country), "REST_COUNT").select(*keys)
    return listing.join(winners, keys, "left_semi")


def busiest_locality_menus(listing: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    return winner_rows(listing, country).select("Locality", "Cuisines")


def busiest_locality_cuisines(listing: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    items = lateral_split(winner_rows(listing, country), "Cuisines", "|")
    return (
        items.groupBy("Locality", "Cuisines")
        .agg(F.count(F.col("Cuisines")).alias("N"))
        .select("Cuisines", "N")
        .orderBy(F.desc("N"), "Cuisines")
    )


def busiest_locality_booking(listing: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    rows = winner_rows(listing, country).filter(eq_ci("Has_Table_booking", "yes"))
    return rows.groupBy("Locality").agg(F.count(F.col("Has_Table_booking")).alias("TABLE_BOOKING_OPTION"))


def booking_vs_rating(listing: DataFrame, locality: str = FOCUS_LOCALITY) -> DataFrame:
    """Count and average rating with and without table booking in one locality
    (two branches, UNION: an empty branch still yields its row)."""
    here = listing.filter(eq_ci("Locality", locality))

    def branch(label: str, answer: str) -> DataFrame:
        return here.filter(eq_ci("Has_Table_booking", answer)).agg(
            F.lit(label).alias("TABLE_BOOKING_OPT"),
            F.count(F.col("Has_Table_booking")).alias("TOTAL_REST"),
            avg_rounded(F.col("Rating"), 2, input_scale=1).alias("AVG_RATING"),
        )

    return branch("WITH_TABLE", "yes").union(branch("WITHOUT_TABLE", "no")).distinct()


def location_ratings(listing: DataFrame) -> DataFrame:
    return (
        listing.groupBy("COUNTRY_NAME", "City", "Locality")
        .agg(
            F.count(F.col("RestaurantID")).alias("TOTAL_REST"),
            avg_rounded(to_whole_decimal("Rating"), 2).alias("AVG_RATING"),
        )
        .orderBy(F.desc("TOTAL_REST"), "COUNTRY_NAME", "City", "Locality")
    )


# Defaults are the Q15 thresholds on the driver's tables (the reference: votes > 1000,
# cost < 1000, cuisines like '%INDIA%').
def best_moderate_cost(listing: DataFrame, country: str = HOME_COUNTRY, max_price: int = 3,
                       min_votes: int = 20, max_cost: float = 990.0, min_rating: float = 4.0,
                       cuisine: str = "%e%") -> DataFrame:
    return listing.filter(
        eq_ci("COUNTRY_NAME", country)
        & eq_ci("Has_Table_booking", "yes")
        & eq_ci("Has_Online_delivery", "yes")
        & (F.col("Price_range") <= max_price)
        & (F.col("Votes") > min_votes)
        & (F.col("Average_Cost_for_two") < max_cost)
        & (F.col("Rating") > F.lit(min_rating))
        & like_ci("Cuisines", cuisine)
    )


def high_rated_by_price(listing: DataFrame, min_rating: float = 4.5) -> DataFrame:
    return (
        listing.filter((F.col("Rating") >= F.lit(min_rating)) & eq_ci("Has_Table_booking", "yes"))
        .groupBy("Price_range")
        .agg(F.count(F.col("Has_Table_booking")).alias("NO_OF_REST"))
    )
