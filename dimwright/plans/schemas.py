"""Declared schemas of the stage, dimension and fact tables, and ``conform``.

``conform`` selects by *name* (never by position), casts to the declared type
and orders the columns as declared; a declared column missing from the input
becomes a typed null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, I, L = T.StringType(), T.DateType(), T.IntegerType(), T.LongType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


CUSTOMERS_STAGE = _schema(*[(c, S) for c in (
    "CustomerName", "CustomerCategoryName", "DeliveryCityName", "DeliveryStateProvinceCode",
    "DeliveryStateProvinceName", "DeliveryCountryName", "DeliveryFormalName", "PostalCityName",
    "PostalStateProvinceCode", "PostalStateProvinceName", "PostalCountryName", "PostalFormalName")])
PRODUCTS_STAGE = _schema(*[(c, S) for c in ("ProductName", "ProductColour", "ProductBrand", "ProductSize")])
SALESPEOPLE_STAGE = _schema(*[(c, S) for c in (
    "FullName", "PreferredName", "LogonName", "PhoneNumber", "FaxNumber", "EmailAddress")])
PICKING_STAFF_STAGE = _schema(*[(c, S) for c in (
    "FullName", "PreferredName", "LogonName", "CustomFields", "PhoneNumber", "FaxNumber", "EmailAddress")])
ORDERS_STAGE = _schema(
    ("OrderDate", D), ("Quantity", I), ("UnitPrice", T.DecimalType(18, 2)), ("TaxRate", T.DecimalType(18, 3)),
    ("CustomerName", S), ("CityName", S), ("StateProvinceName", S), ("CountryName", S),
    ("StockItemName", S), ("LogonName", S), ("PickingStaffName", S),
)
#: What a mart run stages: orders with the natural keys of their members, their lines, and the names of the items.
ORDER_HEADERS_STAGE = _schema(
    ("OrderID", L), ("OrderDate", D), ("CustomerID", L), ("CustomerName", S), ("CityName", S),
    ("StateProvinceName", S), ("CountryName", S), ("LogonName", S), ("PickingStaffName", S),
)
ORDER_LINES_STAGE = _schema(
    ("OrderID", L), ("StockItemID", L), ("Quantity", I), ("UnitPrice", T.DecimalType(18, 2)),
    ("TaxRate", T.DecimalType(18, 3)),
)
STOCK_ITEMS_STAGE = _schema(("StockItemID", L), ("StockItemName", S))
DIM_DATE = _schema(
    ("DateKey", I), ("DateValue", D), ("Year", T.ShortType()), ("Month", T.ShortType()), ("Day", T.ShortType()),
    ("Quarter", T.ShortType()), ("StartOfMonth", D), ("EndOfMonth", D), ("MonthName", S), ("DayOfWeekName", S),
)
_VALIDITY = (("StartDate", D), ("EndDate", D))
DIM_CITIES = _schema(("CityKey", L), *[(c, S) for c in (
    "CityName", "StateProvName", "CountryName", "StateProvCode", "CountryFormalName")])
DIM_SALESPEOPLE = _schema(("SalespersonKey", L), *[(c, S) for c in (
    "LogonName", "FullName", "PreferredName", "PhoneNumber", "FaxNumber", "EmailAddress")])
DIM_CUSTOMERS = _schema(("CustomerKey", L), *[(c, S) for c in (
    "CustomerName", "CustomerCategoryName", "DeliveryCityName", "DeliveryStateProvCode", "DeliveryCountryName",
    "PostalCityName", "PostalStateProvCode", "PostalCountryName")], *_VALIDITY)
DIM_PRODUCTS = _schema(("ProductKey", L), *[(c, S) for c in (
    "ProductName", "ProductColour", "ProductBrand", "ProductSize")], *_VALIDITY)
DIM_PICKING_STAFF = _schema(("PickingStaffKey", L), *[(c, S) for c in (
    "LogonName", "FullName", "PreferredName", "CustomFields", "PhoneNumber", "FaxNumber", "EmailAddress")], *_VALIDITY)
FACT_ORDERS = _schema(
    ("CustomerKey", L), ("CityKey", L), ("ProductKey", L), ("SalespersonKey", L), ("DateKey", I),
    ("PickingStaffKey", L), ("Quantity", I), ("UnitPrice", T.DecimalType(18, 2)),
    ("TaxRate", T.DecimalType(18, 3)), ("TotalBeforeTax", T.DecimalType(18, 2)),
    ("TotalAfterTax", T.DecimalType(18, 2)),
)
#: Every table that a mart run writes; a preload has the schema of its dimension.
SCHEMAS = {
    "customers_stage": CUSTOMERS_STAGE, "products_stage": PRODUCTS_STAGE, "salespeople_stage": SALESPEOPLE_STAGE,
    "picking_staff_stage": PICKING_STAFF_STAGE, "orders_stage": ORDERS_STAGE,
    "order_headers_stage": ORDER_HEADERS_STAGE, "order_lines_stage": ORDER_LINES_STAGE,
    "stock_items_stage": STOCK_ITEMS_STAGE,
    "dim_date": DIM_DATE, "dim_cities": DIM_CITIES, "dim_salespeople": DIM_SALESPEOPLE,
    "dim_customers": DIM_CUSTOMERS, "dim_products": DIM_PRODUCTS, "dim_picking_staff": DIM_PICKING_STAFF,
    "fact_orders": FACT_ORDERS,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
