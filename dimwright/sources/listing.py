"""The restaurant-listing table and its country lookup, derived from the driver tables.

The listing arrives "as imported": every column is text, including numbers, and
it carries columns the cleaning job later drops.  Mapping (one row per part):

    RestaurantID          p_partkey
    CountryCode           p_partkey % 5          (joins region.r_regionkey)
    City / Locality       p_type / p_brand
    Cuisines              p_name with blanks turned into '|'
    Currency              'CUR' || p_partkey % 5
    Rating                p_size / 10 with one decimal (0.1 .. 5.0)
    Average_Cost_for_two  p_retailprice, two decimals
    Price_range           p_partkey % 4 + 1
    Votes                 number of lineitem rows of the part
    Has_Table_booking     'Yes' when p_partkey % 3 = 0, else 'No'
    Has_Online_delivery   'Yes' when p_partkey % 2 = 0, else 'No'
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.sources.tables import read_table


def _yes_no(cond):
    return F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"
    )
    # Partial aggregation runs map-side, so only one row per part and map task
    # crosses the shuffle, however large lineitem is.
    votes = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.count(F.lit(1)).alias("_votes"))
    )
    key = F.col("p_partkey")
    return part.join(votes, part.p_partkey == votes.l_partkey, "left").select(
        key.cast("string").alias("RestaurantID"),
        (key % 5).cast("string").alias("CountryCode"),
        F.col("p_type").alias("City"),
        F.concat(F.col("p_brand"), F.lit(" Road "), key.cast("string")).alias("Address"),
        F.col("p_brand").alias("Locality"),
        F.concat(F.col("p_brand"), F.lit(", "), F.col("p_type")).alias("LocalityVerbose"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("|")).alias("Cuisines"),
        F.concat(F.lit("CUR"), (key % 5).cast("string")).alias("Currency"),
        _yes_no(key % 3 == 0).alias("Has_Table_booking"),
        _yes_no(key % 2 == 0).alias("Has_Online_delivery"),
        _yes_no(key % 7 == 0).alias("Is_delivering_now"),
        F.lit("No").alias("Switch_to_order_menu"),
        (key % 4 + 1).cast("string").alias("Price_range"),
        F.coalesce(F.col("_votes"), F.lit(0)).cast("string").alias("Votes"),
        F.col("p_retailprice").cast("decimal(10,2)").cast("string").alias("Average_Cost_for_two"),
        (F.col("p_size") / 10).cast("decimal(3,1)").cast("string").alias("Rating"),
    )


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COUNTRYCODE -> COUNTRY, from region."""
    return read_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("COUNTRYCODE"),
        F.col("r_name").alias("COUNTRY"),
    )
