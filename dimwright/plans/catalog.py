"""Query registry: one entry per operator of the inventory.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` and runs over the whole input
tables.  Where a behaviour needs values the driver tables do not contain
(nulls, blanks, '?'), the registered query injects them with a deterministic
expression over the real rows, written identically in its SQL oracle.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.functions import dates as fd
from dimwright.functions.measures import total_after_tax, total_before_tax
from dimwright.functions.semantics import (
    any_changed, avg_rounded, eq_ci, is_null_or_blank, like_ci, percentage, to_whole_decimal,
)
from dimwright.operators import grouped, heavy, profile, quality, spelling
from dimwright.operators.joins import (
    asof_carry, asof_lookup, lateral_split, left_join_spread, single_row_broadcast,
)
from dimwright.operators.keys import materialize, with_dense_keys
from dimwright.operators.scd import with_match_keys
from dimwright.operators.load import Mart, replaced_rows, upsert_by_key, write_guarded
from dimwright.plans import changing
from dimwright.plans import extract as ex
from dimwright.plans import history
from dimwright.plans import listings as L
from dimwright.plans import mart as M
from dimwright.sources.landing import land
from dimwright.sources.listing import country_lookup, listings_raw
from dimwright.sources.oltp import Oltp
from dimwright.sources.tables import TABLES, read_table
from dimwright.session import work_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(key: str):
    def deco(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        return fn
    return deco


def raw(spark, d) -> DataFrame:
    return listings_raw(spark, d)


def clean(spark, d) -> DataFrame:
    return L.clean_listings(listings_raw(spark, d), country_lookup(spark, d))


# Injected test values (same expressions in the oracle SQL):
def with_gaps(df: DataFrame) -> DataFrame:
    """Cuisines null for Brand#2, ' ' for Brand#3, '' for Brand#4."""
    c = (F.when(F.col("Locality") == "Brand#2", F.lit(None).cast("string"))
         .when(F.col("Locality") == "Brand#3", F.lit(" "))
         .when(F.col("Locality") == "Brand#4", F.lit(""))
         .otherwise(F.col("Cuisines")))
    return df.withColumn("Cuisines", c)


def with_question_marks(df: DataFrame) -> DataFrame:
    """City with every 'I' turned into '?' (a mis-encoded spelling)."""
    return df.withColumn("City", F.replace(F.col("City"), F.lit("I"), F.lit("?")))


# =====================================================================
# Scans, sources, sinks, catalog
# =====================================================================
@query("scan_full")
def scan_full(spark, d):
    return clean(spark, d)


@query("scan_source_join")
def scan_source_join(spark, d):
    return Oltp(spark, d).orders()


@query("conform_schema")
def conform_schema(spark, d):
    from dimwright.plans.schemas import ORDERS_STAGE, conform
    wide = ex.order_lines_wide(Oltp(spark, d))
    return conform(wide, ORDERS_STAGE)


@query("append_fact")
def append_fact(spark, d):
    src = Oltp(spark, d)
    mart = Mart(spark)
    # Two loads read it: built once, so its lookups meet the dimensions once.
    fact = materialize(M.initial_fact(src))
    mart.write_fact(fact)
    # Loading the same dates again replaces their partitions: no duplicates.
    mart.write_fact(fact)
    return mart.read_fact()


@query("upsert_by_key")
def upsert_by_key_q(spark, d):
    dim, stage, spec, d0 = M.scd2_inputs(Oltp(spark, d), "customers")
    pre = M.apply_scd2(spec, stage, dim, d0 + dt.timedelta(days=1), d0)
    return upsert_by_key(dim.select(*spec.columns), pre.select(*spec.columns), spec.key_col)


@query("view_total_count")
def view_total_count(spark, d):
    lst = clean(spark, d)
    total = lst.agg(F.count(to_whole_decimal("RestaurantID")).alias("TOTAL_REST"))
    name = f"total_count_{uuid.uuid4().hex}"  # no other view of the session is replaced
    lst.select("COUNTRY_NAME").distinct().crossJoin(single_row_broadcast(total)).createOrReplaceTempView(name)
    return spark.table(name)


@query("cte_chain")
def cte_chain(spark, d):
    """Two chained CTEs: localities of the home country by size, then those of the first rank."""
    # The listing is bound as a query argument ({listing}), not a shared temp view.
    return spark.sql(f"""
        WITH sizes AS (
            SELECT COUNTRY_NAME, City, Locality, count(RestaurantID) AS REST_COUNT
            FROM {{listing}}
            WHERE lower(COUNTRY_NAME) = '{L.HOME_COUNTRY.lower()}'
            GROUP BY ALL),
        largest AS (SELECT * FROM sizes WHERE REST_COUNT >= (SELECT max(REST_COUNT) FROM sizes))
        SELECT Locality, REST_COUNT, Cuisines
        FROM largest JOIN {{listing}} USING (COUNTRY_NAME, City, Locality)
    """, listing=clean(spark, d))


@query("profile_columns")
def profile_columns_q(spark, d):
    return profile.profile_columns(spark, {"part": read_table(spark, d, "part")})


@query("profile_tables")
def profile_tables_q(spark, d):
    """All columns of all tables of a session's catalog, which here holds the given tables as views."""
    session = spark.newSession()  # its temporary views are its own
    for t in TABLES:
        read_table(session, d, t).createOrReplaceTempView(t)
    return profile.profile_catalog(session)


@query("extract_date_slice")
def extract_date_slice(spark, d):
    src = Oltp(spark, d)
    d0 = M.first_order_date(src)
    return ex.extract_orders(src, d0, d0)


# =====================================================================
# Projection, filter, predicates, column maintenance
# =====================================================================
@query("project_rename")
def project_rename(spark, d):
    return clean(spark, d).select(
        F.col("RestaurantID").alias("ListingId"), F.col("COUNTRY_NAME").alias("Country"),
        F.col("City"), F.col("Locality").alias("Area"), F.col("Cuisines").alias("Menu"),
    )


@query("project_literals")
def project_literals(spark, d):
    return clean(spark, d).select(
        "RestaurantID",
        F.lit("WITH_TABLE").alias("TABLE_BOOKING_OPT"),
        F.lit("2013-01-01").cast("date").alias("StartDate"),
        F.lit(None).cast("date").alias("EndDate"),
    )


@query("filter_eq_ci")
def filter_eq_ci(spark, d):
    return L.in_country(clean(spark, d)).select("RestaurantID", "COUNTRY_NAME", "City", "Locality")


@query("filter_range")
def filter_range(spark, d):
    return clean(spark, d).filter(F.col("Rating") >= F.lit(4.5)).select("RestaurantID", "Rating", "Price_range")


@query("filter_conjunction")
def filter_conjunction(spark, d):
    return L.best_moderate_cost(clean(spark, d)).select("RestaurantID", "Votes", "Rating", "Cuisines")


@query("filter_disjunction")
def filter_disjunction(spark, d):
    lst = clean(spark, d)
    return lst.filter(eq_ci("Has_Table_booking", "yes") | eq_ci("Has_Online_delivery", "yes")).select(
        "RestaurantID", "Has_Table_booking", "Has_Online_delivery"
    )


# Codes removed by the registered remove_in_list query: the reference's junk list
# plus two real codes; code '4' is turned into null first (it must survive).
REMOVE_CODES = (*L.JUNK_COUNTRY_CODES, "1", "2")


@query("remove_in_list")
def remove_in_list(spark, d):
    df = raw(spark, d).withColumn("CountryCode", F.nullif(F.col("CountryCode"), F.lit("4")))
    return L.remove_in_list(df, "CountryCode", REMOVE_CODES).select("RestaurantID", "CountryCode")


@query("remove_by_key")
def remove_by_key(spark, d):
    return L.remove_by_key(raw(spark, d), "RestaurantID", "7").select("RestaurantID", "City")


@query("filter_null_or_blank")
def filter_null_or_blank(spark, d):
    return with_gaps(raw(spark, d)).filter(is_null_or_blank("Cuisines")).select("RestaurantID", "Cuisines")


@query("filter_like")
def filter_like(spark, d):
    return clean(spark, d).filter(like_ci("Cuisines", "%RING%")).select("RestaurantID", "Cuisines")


@query("distinct_values")
def distinct_values(spark, d):
    return clean(spark, d).select("City").distinct()


@query("distinct_multi")
def distinct_multi(spark, d):
    return clean(spark, d).select("COUNTRY_NAME", "City").distinct()


@query("add_column")
def add_column(spark, d):
    return raw(spark, d).withColumn("COUNTRY_NAME", F.lit(None).cast("string")).select("RestaurantID", "COUNTRY_NAME")


@query("drop_columns")
def drop_columns(spark, d):
    return raw(spark, d).drop(*L.DROPPED_COLUMNS)


@query("retype_columns")
def retype_columns(spark, d):
    return L.retype(raw(spark, d)).select("RestaurantID", "Votes", "Price_range", "Average_Cost_for_two", "Rating")


@query("update_where")
def update_where(spark, d):
    return L.repair_city(with_question_marks(raw(spark, d))).select("RestaurantID", "City")


@query("update_case")
def update_case(spark, d):
    lst = L.retype(raw(spark, d))
    return lst.withColumn("RATE_CATEGORY", L.rating_band("Rating")).select("RestaurantID", "Rating", "RATE_CATEGORY")


@query("update_from_lookup")
def update_from_lookup(spark, d):
    df = raw(spark, d).withColumn("COUNTRY_NAME", F.lit(None).cast("string"))
    out = L.update_from_lookup(df, country_lookup(spark, d), "CountryCode", "COUNTRYCODE", "COUNTRY", "COUNTRY_NAME")
    return out.select("RestaurantID", "CountryCode", "COUNTRY_NAME")


# =====================================================================
# Joins (listing side)
# =====================================================================
@query("join_inner")
def join_inner(spark, d):
    lst = raw(spark, d)
    c = country_lookup(spark, d).withColumnRenamed("COUNTRYCODE", "_code")
    return lst.join(c, lst.CountryCode == c._code, "inner").select("RestaurantID", "CountryCode", "COUNTRY")


@query("join_aggregate_back")
def join_aggregate_back(spark, d):
    lst = clean(spark, d)
    per_city = grouped.group_count(lst, ["COUNTRY_NAME", "City"], "RestaurantID", "CITY_REST")
    return lst.join(per_city, ["COUNTRY_NAME", "City"], "inner").select("RestaurantID", "COUNTRY_NAME", "City",
                                                                          "CITY_REST")


@query("winner_group_rows")
def winner_group_rows(spark, d):
    return L.winner_rows(clean(spark, d)).select("RestaurantID", "City", "Locality")


@query("lateral_split")
def lateral_split_q(spark, d):
    return lateral_split(clean(spark, d), "Cuisines", "|").select("COUNTRY_NAME", "City", "Locality", "Cuisines")


# =====================================================================
# Aggregation
# =====================================================================
@query("dup_key_counts")
def dup_key_counts(spark, d):
    return profile.dup_key_counts(raw(spark, d), "RestaurantID")


@query("value_counts")
def value_counts(spark, d):
    return profile.value_counts(clean(spark, d), "Cuisines")


@query("blank_counts")
def blank_counts(spark, d):
    return profile.blank_counts(with_gaps(raw(spark, d)), "Cuisines")


@query("group_count_multi")
def group_count_multi(spark, d):
    return grouped.group_count(clean(spark, d), ["COUNTRY_NAME", "City", "Locality"], "Locality", "TOTAL_REST")


@query("stats_global")
def stats_global(spark, d):
    return profile.int_stats(clean(spark, d), "Votes", "VT")


@query("stats_by_group")
def stats_by_group(spark, d):
    return profile.int_stats(clean(spark, d), "Average_Cost_for_two", "CST", ["Currency"])


@query("rating_stats")
def rating_stats(spark, d):
    lst = clean(spark, d)
    return lst.agg(
        F.min("Rating").alias("MIN_RATING"),
        avg_rounded(to_whole_decimal("Rating"), 1).alias("AVG_RATING"),
        F.max("Rating").alias("MAX_RATING"),
    )


@query("avg_rating_by_location")
def avg_rating_by_location(spark, d):
    return L.location_ratings(clean(spark, d))


@query("filtered_group_count")
def filtered_group_count(spark, d):
    return L.high_rated_by_price(clean(spark, d))


@query("share_of_total")
def share_of_total(spark, d):
    return L.country_share(clean(spark, d))


@query("share_within_group")
def share_within_group(spark, d):
    return L.online_share(clean(spark, d))


@query("argmax_groups")
def argmax_groups(spark, d):
    return L.busiest_locality(clean(spark, d))


@query("argmin_groups")
def argmin_groups(spark, d):
    return L.quietest_localities(clean(spark, d))


@query("top_group_item_counts")
def top_group_item_counts(spark, d):
    return L.busiest_locality_cuisines(clean(spark, d))


@query("count_cast")
def count_cast(spark, d):
    return clean(spark, d).agg(F.count(to_whole_decimal("RestaurantID")).alias("REST_COUNT"))


# =====================================================================
# Windows, sort, set operations
# =====================================================================
@query("running_count_asc")
def running_count_asc(spark, d):
    return L.running_listings_asc(clean(spark, d))


@query("running_count_desc")
def running_count_desc(spark, d):
    return L.running_listings(clean(spark, d))


@query("grand_total_window")
def grand_total_window(spark, d):
    lst = clean(spark, d)
    total = lst.agg(F.count(to_whole_decimal("RestaurantID")).alias("TOTAL_REST"))
    return lst.select("COUNTRY_NAME").distinct().crossJoin(single_row_broadcast(total))


@query("sort_desc")
def sort_desc(spark, d):
    return profile.value_counts(clean(spark, d), "Currency").orderBy(F.desc("N"), "Currency")


@query("sort_mixed")
def sort_mixed(spark, d):
    return L.listings_per_city(clean(spark, d))


@query("sort_by_name")
def sort_by_name(spark, d):
    return L.quietest_localities(clean(spark, d))


@query("union_distinct")
def union_distinct(spark, d):
    return L.booking_vs_rating(clean(spark, d))


# =====================================================================
# Scalar functions
# =====================================================================
@query("fn_cast_int")
def fn_cast_int(spark, d):
    return clean(spark, d).select("RestaurantID", F.col("Average_Cost_for_two").cast("int").alias("COST_INT"))


@query("fn_cast_decimal")
def fn_cast_decimal(spark, d):
    return clean(spark, d).select("RestaurantID", "Rating", to_whole_decimal("Rating").alias("RATING_WHOLE"))


@query("fn_round")
def fn_round(spark, d):
    lst = clean(spark, d)
    return lst.select(
        "RestaurantID",
        F.round("Rating", 0).cast("decimal(3,0)").alias("ROUND_RATING"),
        F.round(F.col("Average_Cost_for_two").cast("decimal(10,2)"), 1).cast("decimal(10,1)").alias("ROUND_COST"),
    )


@query("fn_replace")
def fn_replace(spark, d):
    df = with_question_marks(raw(spark, d))
    return df.select("RestaurantID", "City", F.replace(F.col("City"), F.lit("?"), F.lit("i")).alias("CITY_FIXED"))


@query("fn_split")
def fn_split(spark, d):
    return lateral_split(clean(spark, d), "Cuisines", "|", "CUISINE").select("RestaurantID", "CUISINE")


@query("rating_band")
def rating_band_q(spark, d):
    return clean(spark, d).select("RestaurantID", "Rating", "RATE_CATEGORY")


@query("fn_percentage")
def fn_percentage(spark, d):
    lst = clean(spark, d)
    agg = lst.groupBy("City").agg(
        F.count(F.when(eq_ci("Has_Table_booking", "yes"), F.col("RestaurantID"))).alias("WITH_BOOKING"),
        F.count("RestaurantID").alias("TOTAL_REST"),
    )
    return agg.withColumn("PCT", percentage(F.col("WITH_BOOKING"), F.col("TOTAL_REST")))


# =====================================================================
# Listing cleaning and questions
# =====================================================================
@query("clean_listings")
def clean_listings(spark, d):
    return clean(spark, d)


@query("misspelled_cities")
def misspelled_cities(spark, d):
    return L.misspelled_cities(with_question_marks(raw(spark, d)))


@query("misspelt_places")
def misspelt_places(spark, d):
    return spelling.misspellings(L.with_misspelt_places(raw(spark, d)), "Place", ratio=3)


@query("busiest_locality_sketch")
def busiest_locality_sketch(spark, d):
    """busiest_locality by a sketch of the counts, proven and counted exactly."""
    rows = L.in_country(clean(spark, d)).where(F.col("RestaurantID").isNotNull())
    return heavy.busiest_groups(rows, ["COUNTRY_NAME", "City", "Locality"], "REST_COUNT").select("Locality", "REST_COUNT")


@query("busiest_parts")
def busiest_parts(spark, d):
    """The parts on most order lines: far more groups than the sketch holds."""
    return heavy.busiest_groups(read_table(spark, d, "lineitem").select("l_partkey"), ["l_partkey"], "N", counters=512)


@query("listings_per_city")
def listings_per_city(spark, d):
    return L.listings_per_city(clean(spark, d))


@query("running_listings")
def running_listings(spark, d):
    return L.running_listings(clean(spark, d))


@query("running_listings_blocks")
def running_listings_blocks(spark, d):
    """running_listings by a distributed prefix sum."""
    counts = L.listings_per_locality(clean(spark, d))
    return grouped.running_total_blocks(
        counts, ["COUNTRY_NAME", "City"], [("Locality", False)], "TOTAL_REST", "ROLL_COUNT")


@query("running_lines_blocks")
def running_lines_blocks(spark, d):
    """Running quantity over all lines of each return flag by ship date: a few hot partitions, every date with peers."""
    lines = read_table(spark, d, "lineitem").select(
        "l_returnflag", F.col("l_shipdate").cast("date").alias("SHIPPED"), "l_orderkey", "l_linenumber",
        F.col("l_quantity").cast("long").alias("QUANTITY"))
    return grouped.running_total_blocks(lines, ["l_returnflag"], [("SHIPPED", True)], "QUANTITY", "ROLL_QUANTITY")


@query("country_share")
def country_share(spark, d):
    return L.country_share(clean(spark, d))


@query("listings_per_country")
def listings_per_country(spark, d):
    return L.listings_per_country(clean(spark, d))


@query("online_share")
def online_share(spark, d):
    return L.online_share(clean(spark, d))


@query("busiest_locality")
def busiest_locality(spark, d):
    return L.busiest_locality(clean(spark, d)).select("Locality", "REST_COUNT")


@query("busiest_locality_menus")
def busiest_locality_menus(spark, d):
    return L.busiest_locality_menus(clean(spark, d))


@query("busiest_locality_cuisines")
def busiest_locality_cuisines(spark, d):
    return L.busiest_locality_cuisines(clean(spark, d))


@query("quietest_localities")
def quietest_localities(spark, d):
    return L.quietest_localities(clean(spark, d))


@query("busiest_locality_booking")
def busiest_locality_booking(spark, d):
    return L.busiest_locality_booking(clean(spark, d))


@query("booking_vs_rating")
def booking_vs_rating(spark, d):
    return L.booking_vs_rating(clean(spark, d))


@query("location_ratings")
def location_ratings(spark, d):
    return L.location_ratings(clean(spark, d))


@query("best_moderate_cost")
def best_moderate_cost(spark, d):
    return L.best_moderate_cost(clean(spark, d))


@query("high_rated_by_price")
def high_rated_by_price(spark, d):
    return L.high_rated_by_price(clean(spark, d))


# =====================================================================
# Order database: joins, extracts
# =====================================================================
def src_of(spark, d) -> Oltp:
    return Oltp(spark, d)


@query("join_left")
def join_left(spark, d):
    src = src_of(spark, d)
    pickers = src.people.select(F.col("PersonID").alias("PickedByPersonID"), F.col("LogonName").alias("PickerLogon"))
    return left_join_spread(src.orders(), pickers, "PickedByPersonID", by="OrderID").select("OrderID", "PickerLogon")


@query("join_snowflake")
def join_snowflake(spark, d):
    return ex.city_details(src_of(spark, d))


@query("join_role_playing")
def join_role_playing(spark, d):
    return ex.extract_customers(src_of(spark, d)).select(
        "CustomerName", "DeliveryCityName", "DeliveryCountryName", "PostalCityName", "PostalCountryName"
    )


WIDE_COLUMNS = ("OrderID", "LineNumber", "OrderDate", "CustomerName", "Quantity", "UnitPrice", "TaxRate",
                "LogonName", "CityName", "StateProvinceName", "CountryName", "StockItemName", "PickingStaffName")


@query("join_order_lines_wide")
def join_order_lines_wide(spark, d):
    return ex.order_lines_wide(src_of(spark, d)).select(*WIDE_COLUMNS)


@query("extract_customers")
def extract_customers(spark, d):
    return ex.extract_customers(src_of(spark, d))


@query("extract_products")
def extract_products(spark, d):
    return ex.extract_products(src_of(spark, d))


@query("extract_salespeople")
def extract_salespeople(spark, d):
    return ex.extract_salespeople(src_of(spark, d))


@query("extract_picking_staff")
def extract_picking_staff(spark, d):
    return ex.extract_picking_staff(src_of(spark, d))


@query("extract_orders")
def extract_orders(spark, d):
    return ex.extract_orders(src_of(spark, d))


@query("extract_orders_landed")
def extract_orders_landed(spark, d):
    """extract_orders from a landing zone bucketed by order key."""
    return ex.extract_orders(land(src_of(spark, d)))


@query("extract_slice_landed")
def extract_slice_landed(spark, d):
    """extract_date_slice from the landing zone."""
    src = land(src_of(spark, d))
    d0 = M.first_order_date(src)
    return ex.extract_orders(src, d0, d0)


@query("rowcount_guard")
def rowcount_guard(spark, d):
    path = work_path(spark, "customers_stage")
    write_guarded(ex.extract_customers(src_of(spark, d)), path, name="customers")
    return spark.read.parquet(path)


# =====================================================================
# Type-1 dimensions: the dimension before is derived from the sources
# (even city ids / every fourth salesperson already known, names of the
# known salespeople changed so the type-1 overwrite shows; some business keys
# are spelled in other case or with a trailing blank, which must not matter).
# =====================================================================
def cities_before(src: Oltp) -> DataFrame:
    det = ex.city_details(src).filter(F.col("CityID") % 2 == 0)
    return det.select(
        (F.col("CityID") + 1).cast("long").alias("CityKey"),
        F.when(F.col("CityID") % 4 == 0, F.concat(F.lower("CityName"), F.lit(" "))).otherwise(F.col("CityName"))
        .alias("CityName"),
        F.col("StateProvinceName").alias("StateProvName"),
        "CountryName",
        F.col("StateProvinceCode").alias("StateProvCode"),
        F.col("FormalName").alias("CountryFormalName"),
    )


def salespeople_before(src: Oltp) -> DataFrame:
    sp = src.people.filter((F.col("IsSalesperson") == 1) & (F.col("PersonID") % 4 == 0))
    return sp.select(
        (F.col("PersonID") + 1).cast("long").alias("SalespersonKey"),
        F.when(F.col("PersonID") % 8 == 0, F.upper("LogonName")).otherwise(F.col("LogonName")).alias("LogonName"),
        F.concat(F.lit("OLD "), F.col("FullName")).alias("FullName"),
        "PreferredName", "PhoneNumber", "FaxNumber", "EmailAddress",
    )


def delivery_cities_stage(src: Oltp) -> DataFrame:
    return ex.extract_customers(src).select(
        "CustomerName", F.col("DeliveryCityName").alias("CityName"),
        F.col("DeliveryStateProvinceName").alias("StateProvName"), F.col("DeliveryCountryName").alias("CountryName"),
    )


CITY_KEYS = ["CityName", "StateProvName", "CountryName"]


def _city_match(src: Oltp) -> tuple[DataFrame, DataFrame, list[str]]:
    """Delivery cities and known cities with the compared form of their three-part key."""
    names = [f"_m{i}" for i in range(len(CITY_KEYS))]
    known = with_match_keys(cities_before(src), CITY_KEYS).select("CityKey", *names)
    return with_match_keys(delivery_cities_stage(src), CITY_KEYS), known, names


@query("join_composite")
def join_composite(spark, d):
    stage, known, names = _city_match(src_of(spark, d))
    return stage.join(known, names, "inner").select("CustomerName", "CityKey")


@query("anti_join_composite")
def anti_join_composite(spark, d):
    stage, known, names = _city_match(src_of(spark, d))
    return stage.join(known, names, "left_anti").select("CustomerName", *CITY_KEYS)


@query("scd1_cities")
def scd1_cities(spark, d):
    src = src_of(spark, d)
    return M.apply_scd1(M.CITIES, ex.extract_customers(src), cities_before(src))


@query("scd1_salespeople")
def scd1_salespeople(spark, d):
    src = src_of(spark, d)
    return M.apply_scd1(M.SALESPEOPLE, ex.extract_salespeople(src), salespeople_before(src))


@query("surrogate_keys")
def surrogate_keys(spark, d):
    lines = read_table(spark, d, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
             "l_extendedprice", "l_returnflag", "l_linestatus", "l_tax", "l_discount"]
    keyed = with_dense_keys(lines, order, "LineKey", key_type="long")
    return keyed.select("LineKey", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# =====================================================================
# Type-2 dimensions (inputs by id % 10, see mart.scd2_fixture)
# =====================================================================
def _scd2_parts(spark, d, which="customers"):
    dim, stage, spec, d0 = M.scd2_inputs(src_of(spark, d), which)
    parts = M.scd2_branches(spec, stage, dim, d0 + dt.timedelta(days=1), d0)
    return parts, dim, stage, spec, d0


@query("scd2_changed")
def scd2_changed(spark, d):
    return _scd2_parts(spark, d)[0]["changed"]


@query("scd2_closed_and_carried")
def scd2_closed_and_carried(spark, d):
    return _scd2_parts(spark, d)[0]["closed"]


@query("scd2_new")
def scd2_new(spark, d):
    return _scd2_parts(spark, d)[0]["new"]


@query("scd2_expired")
def scd2_expired(spark, d):
    return _scd2_parts(spark, d)[0]["expired"]


@query("union_all_branches")
def union_all_branches(spark, d):
    parts = _scd2_parts(spark, d)[0]
    out = parts["changed"]
    for k in ("closed", "new", "expired", "history"):
        out = out.unionByName(parts[k])
    return out


@query("scd2_customers")
def scd2_customers(spark, d):
    return M.scd2_run(src_of(spark, d), "customers")


@query("scd2_products")
def scd2_products(spark, d):
    return M.scd2_run(src_of(spark, d), "products")


@query("scd2_picking_staff")
def scd2_picking_staff(spark, d):
    return M.scd2_run(src_of(spark, d), "picking_staff")


@query("filter_open_rows")
def filter_open_rows(spark, d):
    dim = M.scd2_inputs(src_of(spark, d), "customers")[0]
    return dim.filter(F.col("EndDate").isNull())


def _stage_vs_open(spark, d):
    dim, stage, spec, d0 = M.scd2_inputs(src_of(spark, d), "customers")
    dim, stage = with_match_keys(dim, ["CustomerName"]), with_match_keys(stage, ["CustomerName"])
    open_rows = dim.filter(F.col("EndDate").isNull()).select(
        "CustomerKey", "_m0", *[F.col(a).alias(f"OLD_{a}") for a in spec.attrs]
    )
    changed = any_changed([(stage[a], open_rows[f"OLD_{a}"]) for a in spec.attrs])
    return stage.join(open_rows, "_m0", "inner").filter(changed), dim, stage, spec, d0


@query("changed_rows")
def changed_rows(spark, d):
    j, _, stage, spec, _ = _stage_vs_open(spark, d)
    return j.select("CustomerName", *spec.attrs)


@query("join_residual")
def join_residual(spark, d):
    j = _stage_vs_open(spark, d)[0]
    return j.select("CustomerName", "CustomerKey", F.col("CustomerCategoryName").alias("NEW_CATEGORY"),
                    F.col("OLD_CustomerCategoryName").alias("OLD_CATEGORY"))


def _left_on_open(spark, d):
    j, dim, _, _, d0 = _stage_vs_open(spark, d)
    pl = j.select(F.col("CustomerName").alias("PL_NAME"), F.col("_m0").alias("_pl"))
    joined = dim.join(pl, (dim["_m0"] == pl["_pl"]) & dim.EndDate.isNull(), "left")
    return joined, d0


@query("join_left_on_predicate")
def join_left_on_predicate(spark, d):
    joined, _ = _left_on_open(spark, d)
    return joined.select("CustomerKey", "CustomerName", "StartDate", "PL_NAME")


@query("fn_case_null")
def fn_case_null(spark, d):
    joined, d0 = _left_on_open(spark, d)
    end = F.when(F.col("PL_NAME").isNotNull(), F.lit(str(d0)).cast("date"))
    return joined.select("CustomerKey", end.alias("NEW_END_DATE"))


@query("anti_join")
def anti_join(spark, d):
    dim, stage, _, _ = M.scd2_inputs(src_of(spark, d), "customers")
    known = with_match_keys(dim, ["CustomerName"]).select("_m0")
    return with_match_keys(stage, ["CustomerName"]).join(known, "_m0", "left_anti").select("CustomerName")


@query("replaced_rows")
def replaced_rows_q(spark, d):
    dim, stage, spec, d0 = M.scd2_inputs(src_of(spark, d), "customers")
    pre = M.apply_scd2(spec, stage, dim, d0 + dt.timedelta(days=1), d0)
    return replaced_rows(dim.select(*spec.columns), pre, spec.key_col)


def _load_type2(spark, d, which: str) -> DataFrame:
    dim, stage, spec, d0 = M.scd2_inputs(src_of(spark, d), which)
    mart = Mart(spark)
    mart.publish(spec.name, dim.select(*spec.columns))
    pre = M.apply_scd2(spec, stage, mart.read(spec.name), d0 + dt.timedelta(days=1), d0)
    return mart.upsert(spec.name, pre.select(*spec.columns), spec.key_col)


def _load_type1(spark, spec: M.DimSpec, stage: DataFrame, before: DataFrame) -> DataFrame:
    mart = Mart(spark)
    mart.publish(spec.name, before.select(*spec.columns))
    pre = M.apply_scd1(spec, stage, mart.read(spec.name))
    return mart.upsert(spec.name, pre.select(*spec.columns), spec.key_col)


@query("load_dimension")
def load_dimension(spark, d):
    return _load_type2(spark, d, "customers")


@query("load_products")
def load_products(spark, d):
    return _load_type2(spark, d, "products")


@query("load_picking_staff")
def load_picking_staff(spark, d):
    return _load_type2(spark, d, "picking_staff")


@query("load_cities")
def load_cities(spark, d):
    src = src_of(spark, d)
    return _load_type1(spark, M.CITIES, ex.extract_customers(src), cities_before(src))


@query("load_salespeople")
def load_salespeople(spark, d):
    src = src_of(spark, d)
    return _load_type1(spark, M.SALESPEOPLE, ex.extract_salespeople(src), salespeople_before(src))


@query("scd2_same_date_correction")
def scd2_same_date_correction(spark, d):
    """The run of the day is repeated with a corrected stage: of the members opened that day, names ending in 7
    or 9 get another category (same key), names ending in 5 are gone (withdrawn)."""
    dim, stage, spec, d0 = M.scd2_inputs(src_of(spark, d), "customers")
    day = d0 + dt.timedelta(days=1)
    first = materialize(M.apply_scd2(spec, stage, dim, day, d0))
    last = F.right(F.rtrim("CustomerName"), F.lit(1))
    corrected = stage.filter(last != "5").withColumn("CustomerCategoryName", F.when(
        last.isin("7", "9"), F.concat(F.lit("FIX "), F.col("CustomerCategoryName"))).otherwise(
        F.col("CustomerCategoryName")))
    return M.apply_scd2(spec, corrected, first, day, d0)


def _orders_and_versions(spark, d):
    src = src_of(spark, d)
    versions = M.scd2_run(src, "customers")
    return src.orders().join(src.customers.select("CustomerID", "CustomerName"), "CustomerID", "left"), versions


@query("join_asof_dimension")
def join_asof_dimension(spark, d):
    orders, versions = _orders_and_versions(spark, d)
    out = asof_lookup(orders, versions, ["CustomerName"], ["CustomerName"], "OrderDate",
                      {"CustomerKey": "CustomerKey"})
    return out.select("OrderID", "OrderDate", "CustomerKey")


@query("join_asof_carry")
def join_asof_carry(spark, d):
    orders, versions = _orders_and_versions(spark, d)
    out = asof_carry(orders, versions, ["CustomerName"], ["CustomerName"], "OrderDate", {"CustomerKey": "CustomerKey"})
    return out.select("OrderID", "OrderDate", "CustomerKey")


@query("scd2_change_log")
def scd2_change_log(spark, d):
    return history.change_log_history(src_of(spark, d))


@query("scd2_late_day")
def scd2_late_day(spark, d):
    """Without the surrogate keys and the spelling of names, which depend on the order of arrival."""
    late = history.late_customers(src_of(spark, d)).drop("CustomerKey")
    return late.withColumn("CustomerName", F.upper(F.rtrim("CustomerName")))


@query("periods_out_of_order")
def periods_out_of_order(spark, d):
    """As daily_run_changing_source, with the second period loaded last."""
    return changing.sales(history.periods_out_of_order(spark, d))


# =====================================================================
# Calendar and measures
# =====================================================================
def order_dates(spark, d) -> DataFrame:
    return src_of(spark, d).orders().select("OrderDate").distinct()


@query("fn_date_parts")
def fn_date_parts(spark, d):
    o = order_dates(spark, d)
    return o.select("OrderDate", F.year("OrderDate").alias("YEAR"), F.month("OrderDate").alias("MONTH"),
                    F.dayofmonth("OrderDate").alias("DAY"))


@query("fn_quarter")
def fn_quarter(spark, d):
    return order_dates(spark, d).select("OrderDate", F.quarter("OrderDate").alias("QUARTER"))


@query("fn_month_start")
def fn_month_start(spark, d):
    return order_dates(spark, d).select("OrderDate", fd.month_start(F.col("OrderDate")).alias("MONTH_START"))


@query("fn_month_end")
def fn_month_end(spark, d):
    return order_dates(spark, d).select("OrderDate", fd.month_end(F.col("OrderDate")).alias("MONTH_END"))


@query("fn_date_names")
def fn_date_names(spark, d):
    return order_dates(spark, d).select(
        "OrderDate", fd.month_name(F.col("OrderDate")).alias("MONTH_NAME"),
        fd.day_name(F.col("OrderDate")).alias("DAY_NAME"),
    )


@query("fn_date_key")
def fn_date_key(spark, d):
    return order_dates(spark, d).select("OrderDate", fd.date_key(F.col("OrderDate")).alias("DATE_KEY"))


@query("fn_to_date")
def fn_to_date(spark, d):
    o = src_of(spark, d).orders().select("OrderID", F.date_format("OrderDate", "yyyy-MM-dd").alias("ORDER_DATE_TEXT"))
    return o.withColumn("ORDER_DATE", F.to_date("ORDER_DATE_TEXT"))


@query("fn_total_before_tax")
def fn_total_before_tax(spark, d):
    lines = src_of(spark, d).order_lines
    return lines.select("OrderID", "LineNumber", "Quantity", "UnitPrice",
                        total_before_tax(F.col("Quantity"), F.col("UnitPrice")).alias("TOTAL_BEFORE_TAX"))


@query("fn_total_after_tax")
def fn_total_after_tax(spark, d):
    lines = src_of(spark, d).order_lines
    return lines.select("OrderID", "LineNumber", "Quantity", "UnitPrice", "TaxRate",
                        total_after_tax(F.col("Quantity"), F.col("UnitPrice"), F.col("TaxRate"))
                        .alias("TOTAL_AFTER_TAX"))


@query("dim_date")
def dim_date(spark, d):
    return M.dim_date_for_orders(src_of(spark, d))


# =====================================================================
# Fact, loads, daily run, quality, summary
# =====================================================================
@query("fact_orders")
def fact_orders(spark, d):
    return M.initial_fact(src_of(spark, d))


@query("star_lookup")
def star_lookup(spark, d):
    """The reference's lookup: inner joins, so lines without a member drop out."""
    return M.initial_fact(src_of(spark, d), strict=True)


@query("load_fact")
def load_fact(spark, d):
    mart = Mart(spark)
    mart.write_fact(M.initial_fact(src_of(spark, d)))
    return mart.read_fact()


@query("daily_run")
def daily_run(spark, d):
    return M.daily_run(src_of(spark, d))


@query("daily_run_changing_source")
def daily_run_changing_source(spark, d):
    """Three runs over a source whose members change in between; sales by the values valid at the time."""
    mart = changing.run_periods(spark, d)
    return changing.sales(mart)


@query("changed_members")
def changed_members(spark, d):
    return history.changed_customers(spark, d)


@query("kept_summary")
def kept_summary(spark, d):
    """mart_summary kept up to date by three loads."""
    return history.kept_summary(spark, d)


@query("late_members")
def late_members(spark, d):
    return history.late_members(spark, d)


@query("dq_duplicate_keys")
def dq_duplicate_keys(spark, d):
    return quality.duplicate_keys(src_of(spark, d).order_lines, ["OrderID", "LineNumber"])


def _initial_mart(spark, d):
    src = src_of(spark, d)
    dims = M.build_dimensions(src, M.first_order_date(src))
    fact = M.fact_of_orders(ex.order_headers(src), ex.order_items(src), dims)
    return src, dims, fact


@query("dq_orphan_keys")
def dq_orphan_keys(spark, d):
    src, dims, fact = _initial_mart(spark, d)
    refs = {
        "CustomerKey": (dims["customers"], "CustomerKey"), "CityKey": (dims["cities"], "CityKey"),
        "ProductKey": (dims["products"], "ProductKey"), "SalespersonKey": (dims["salespeople"], "SalespersonKey"),
        "DateKey": (M.dim_date_for_orders(src), "DateKey"),
        "PickingStaffKey": (dims["picking_staff"], "PickingStaffKey"),
    }
    return quality.orphan_keys(fact, refs)


@query("dq_null_counts")
def dq_null_counts(spark, d):
    """Nulls per column of the orders stage, and in the NOT NULL columns of the mart."""
    src, dims, fact = _initial_mart(spark, d)
    stage = quality.null_counts(ex.extract_orders(src)).select(
        F.lit("orders_stage").alias("TABLE_NAME"), "COLUMN_NAME", "NULL_COUNT")
    return stage.unionByName(M.mart_nulls(dims, M.dim_date_for_orders(src), fact))


@query("mart_summary")
def mart_summary(spark, d):
    src, dims, fact = _initial_mart(spark, d)
    return M.mart_summary(fact, dims["customers"], M.dim_date_for_orders(src))
