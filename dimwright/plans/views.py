"""Temp views for SQL users: the same data the jobs use, queryable with spark.sql.

``register_views(spark, sf_dir)`` registers (all lazy, over the whole tables):

    listing_raw, listing, country                       the listing and its lookup
    cities, state_provinces, countries, customers,      order-database source views
    customer_categories, stock_items, colors, people,
    orders, order_lines
    customers_stage, products_stage, salespeople_stage, extracts
    picking_staff_stage, orders_stage
    dim_date                                            calendar over the order dates

and, with ``mart=True``, the first-load mart: dim_cities, dim_salespeople,
dim_customers, dim_products, dim_picking_staff, fact_orders (building it
materialises the dimensions once).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from dimwright.plans import extract as ex
from dimwright.plans import listings as L
from dimwright.plans import mart as M
from dimwright.sources.listing import country_lookup, listings_raw
from dimwright.sources.oltp import Oltp


def register_views(spark: SparkSession, sf_dir: str, mart: bool = False) -> list[str]:
    src = Oltp(spark, sf_dir)
    raw, country = listings_raw(spark, sf_dir), country_lookup(spark, sf_dir)
    views = {
        "listing_raw": raw,
        "listing": L.clean_listings(raw, country),
        "country": country,
        "cities": src.cities,
        "state_provinces": src.state_provinces,
        "countries": src.countries,
        "customers": src.customers,
        "customer_categories": src.customer_categories,
        "stock_items": src.stock_items,
        "colors": src.colors,
        "people": src.people,
        "orders": src.orders(),
        "order_lines": src.order_lines,
        "customers_stage": ex.extract_customers(src),
        "products_stage": ex.extract_products(src),
        "salespeople_stage": ex.extract_salespeople(src),
        "picking_staff_stage": ex.extract_picking_staff(src),
        "orders_stage": ex.extract_orders(src),
        "dim_date": M.dim_date_for_orders(src),
    }
    if mart:
        dims = M.build_dimensions(src, M.first_order_date(src))
        views.update({M.SPEC_BY_DIM[k].name: v for k, v in dims.items()})
        views["fact_orders"] = M.fact_orders(views["orders_stage"], dims)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
