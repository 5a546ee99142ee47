"""Extracts from the order database into stage-shaped DataFrames.

Stages stay lazy and joins carry no hints: the planner broadcasts the small
lookups (cities, categories, colours) by their size in bytes and shuffles the
large ones (customers, order lines, stock items) on the join key.  Keys that are
null in many rows (pickers, items of orders without lines) are spread.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.operators.joins import left_join_small_preserved, left_join_spread
from dimwright.sources.oltp import Oltp

CITY_DETAIL_COLUMNS = ("CityName", "StateProvinceCode", "StateProvinceName", "CountryName", "FormalName")
CUSTOMER_STAGE_COLUMNS = (
    "CustomerName", "CustomerCategoryName",
    "DeliveryCityName", "DeliveryStateProvinceCode", "DeliveryStateProvinceName", "DeliveryCountryName",
    "DeliveryFormalName",
    "PostalCityName", "PostalStateProvinceCode", "PostalStateProvinceName", "PostalCountryName",
    "PostalFormalName",
)
PRODUCT_STAGE_COLUMNS = ("ProductName", "ProductColour", "ProductBrand", "ProductSize")
PEOPLE_STAGE_COLUMNS = ("FullName", "PreferredName", "LogonName", "PhoneNumber", "FaxNumber", "EmailAddress")
PICKING_STAGE_COLUMNS = ("FullName", "PreferredName", "LogonName", "CustomFields", "PhoneNumber", "FaxNumber",
                         "EmailAddress")
ORDER_STAGE_COLUMNS = (
    "OrderDate", "Quantity", "UnitPrice", "TaxRate", "CustomerName", "CityName", "StateProvinceName",
    "CountryName", "StockItemName", "LogonName", "PickingStaffName",
)


def city_details(src: Oltp) -> DataFrame:
    """Cities -> state/province -> country (snowflake flattened by two left joins)."""
    sp = src.lookup("state_provinces")
    co = src.lookup("countries")
    return (
        src.cities.join(sp, "StateProvinceID", "left")
        .join(co, "CountryID", "left")
        .select("CityID", *CITY_DETAIL_COLUMNS)
    )


def _role(details: DataFrame, prefix: str) -> DataFrame:
    """The city lookup in one role (delivery / postal), columns prefixed."""
    return details.select(
        F.col("CityID").alias(f"{prefix}CityID"),
        *[F.col(c).alias(f"{prefix}{c}") for c in CITY_DETAIL_COLUMNS],
    )


def extract_customers(src: Oltp, keep_id: bool = False) -> DataFrame:
    details = src.lookup("city_details", city_details)
    cats = src.lookup("customer_categories")
    out = (
        src.customers.join(cats, "CustomerCategoryID", "left")
        .join(_role(details, "Delivery"), "DeliveryCityID", "left")
        .join(_role(details, "Postal"), "PostalCityID", "left")
    )
    return out.select(*(("CustomerID",) if keep_id else ()), *CUSTOMER_STAGE_COLUMNS)


def extract_products(src: Oltp, keep_id: bool = False) -> DataFrame:
    colors = src.lookup("colors")
    return src.stock_items.join(colors, "ColorID", "left").select(
        *(("StockItemID",) if keep_id else ()),
        F.col("StockItemName").alias("ProductName"),
        F.col("ColorName").alias("ProductColour"),
        F.col("Brand").alias("ProductBrand"),
        F.col("Size").alias("ProductSize"),
    )


def extract_salespeople(src: Oltp) -> DataFrame:
    return src.people.filter(F.col("IsSalesperson") == 1).select(*PEOPLE_STAGE_COLUMNS)


def extract_picking_staff(src: Oltp, keep_id: bool = False) -> DataFrame:
    """People who picked at least one order - one row each, no null logons.

    A semi join keeps each person once however many orders they picked.
    """
    # Distinct first: partial aggregation runs map-side, so a picker holding a
    # large share of all orders never lands as raw rows in one task.
    pickers = (
        src.orders().select(F.col("PickedByPersonID").alias("PersonID"))
        .filter(F.col("PersonID").isNotNull())
        .distinct()
    )
    return (
        src.people.join(pickers, "PersonID", "left_semi")
        .filter(F.col("LogonName").isNotNull())
        .select(*(("PersonID",) if keep_id else ()), *PICKING_STAGE_COLUMNS)
    )


def cust_cols(src: Oltp) -> DataFrame:
    return src.customers.select("CustomerID", "CustomerName", "DeliveryCityID")


def order_headers(src: Oltp, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Orders with the natural keys of their members - customer, delivery city, salesperson, picker."""
    orders = src.orders(start, end)
    if start is None and end is None:
        # Backfill: orders are as large as anything else here; a shuffled join.
        with_customer = orders.join(cust_cols(src), "CustomerID", "left")
    else:
        # A date range: usually few orders, so customers are reduced to its keys first.
        with_customer = left_join_small_preserved(orders, cust_cols(src), "CustomerID")
    details = src.lookup("city_details", city_details)
    people = src.lookup("people_logons", lambda s: s.people.select("PersonID", "LogonName"))
    sales = people.select(F.col("PersonID").alias("SalespersonPersonID"), F.col("LogonName"))
    pickers = people.select(F.col("PersonID").alias("PickedByPersonID"), F.col("LogonName").alias("PickingStaffName"))
    places = details.select(
        F.col("CityID").alias("DeliveryCityID"), "CityName", "StateProvinceName", "CountryName")
    placed = with_customer.join(sales, "SalespersonPersonID", "left").join(places, "DeliveryCityID", "left")
    return left_join_spread(placed, pickers, "PickedByPersonID", by="OrderID")


def item_names(src: Oltp) -> DataFrame:
    return src.stock_items.select("StockItemID", "StockItemName")


def lines_of(src: Oltp, orders: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The lines of some staged ``orders`` of a date range, with the id of their product.

    The staged copy's size is known in bytes: few order keys are broadcast and the lines stream past them,
    many are shuffled.
    """
    return src.lines(start, end).join(orders.select("OrderID"), "OrderID", "left_semi")


def order_items(src: Oltp) -> DataFrame:
    """All order lines with the natural key of their product."""
    return left_join_spread(src.order_lines, item_names(src), "StockItemID", by="OrderID")


def order_lines_wide(src: Oltp, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Orders left-joined to customer, lines, salesperson, city, province,
    country, stock item and picker (nine inputs), optionally one date range.

    What belongs to an order is joined before its lines multiply it.  Orders
    without lines are kept with null line columns.
    """
    headers = order_headers(src, start, end)
    if start is None and end is None:
        with_lines = headers.join(src.order_lines, "OrderID", "left")
    else:  # lines are reduced to the range's orders instead of being shuffled whole
        with_lines = left_join_small_preserved(headers, src.lines(start, end), "OrderID")
    return left_join_spread(with_lines, item_names(src), "StockItemID", by="OrderID")


def extract_orders(src: Oltp, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """The orders stage for a date range (all dates when both are None)."""
    return order_lines_wide(src, start, end).select(*ORDER_STAGE_COLUMNS)
