"""SQL over the registered views agrees with the DataFrame operators."""

from dimwright.plans import listings as L
from dimwright.plans.views import register_views
from dimwright.sources.listing import country_lookup, listings_raw

SF = "/root/testdata/sf0.001"


def test_sql_questions_match_operators(spark):
    names = register_views(spark, SF, mart=True)
    assert {"listing", "orders_stage", "dim_customers", "fact_orders"} <= set(names)
    lst = L.clean_listings(listings_raw(spark, SF), country_lookup(spark, SF))

    per_country = spark.sql(
        "SELECT COUNTRY_NAME, count(CAST(RestaurantID AS DECIMAL(18,0))) AS REST_COUNT "
        "FROM listing GROUP BY COUNTRY_NAME")
    assert {tuple(r) for r in per_country.collect()} == {tuple(r) for r in L.listings_per_country(lst).collect()}

    busiest = spark.sql("""
        WITH ct1 AS (SELECT City, Locality, count(RestaurantID) AS REST_COUNT FROM listing
                     WHERE lower(COUNTRY_NAME) = 'asia' GROUP BY City, Locality)
        SELECT City, Locality, REST_COUNT FROM ct1 WHERE REST_COUNT = (SELECT max(REST_COUNT) FROM ct1)""")
    assert {tuple(r) for r in busiest.collect()} == {tuple(r) for r in L.busiest_locality(lst).collect()}

    orphans = spark.sql("""
        SELECT count(*) AS n FROM fact_orders f
        LEFT ANTI JOIN dim_customers d ON f.CustomerKey = d.CustomerKey""").first()["n"]
    assert orphans == 0
