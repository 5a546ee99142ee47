"""Order-database source views, derived from the driver tables.

    Cities            nation:   CityID = n_nationkey, CityName = n_name
    StateProvinces    nation:   code 'N' || n_nationkey, name n_name || ' Province',
                                CountryID = n_regionkey
    Countries         region:   CountryName = r_name, FormalName = 'Formal ' || r_name
    Customers         customer: name c_name, category c_mktsegment,
                                delivery city c_nationkey, postal city (c_nationkey + 7) % 25
    CustomerCategories distinct c_mktsegment
    StockItems        part:     name p_name || ' #' || p_partkey, brand, size,
                                colour = first word of p_name
    Colors            distinct first word of p_name
    People            supplier: logon lower(s_name with '#' -> '.'),
                                salesperson when s_suppkey % 2 = 0
    Orders            orders:   salesperson (o_custkey % 50) * 2 % n_suppliers,
                                picker o_orderkey % n_suppliers, null when o_orderstatus = 'O'
    OrderLines        lineitem: quantity int(l_quantity),
                                price l_extendedprice / quantity rounded half-up to cents,
                                tax rate l_tax * 100 as decimal(18,3)
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.functions.semantics import cents_of, half_up_quotient
from dimwright.operators.joins import single_row_broadcast
from dimwright.sources.tables import read_table


class Oltp:
    """Lazy source views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._lookups: dict[str, DataFrame] = {}

    def lookup(self, name: str, build=None) -> DataFrame:
        """A view that several extracts join to, built once per source."""
        if name not in self._lookups:
            self._lookups[name] = build(self) if build is not None else getattr(self, name)
        return self._lookups[name]

    def _t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # -- geography -------------------------------------------------------
    @cached_property
    def cities(self) -> DataFrame:
        return self._t("nation").select(
            F.col("n_nationkey").alias("CityID"),
            F.col("n_name").alias("CityName"),
            F.col("n_nationkey").alias("StateProvinceID"),
        )

    @cached_property
    def state_provinces(self) -> DataFrame:
        return self._t("nation").select(
            F.col("n_nationkey").alias("StateProvinceID"),
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("StateProvinceCode"),
            F.concat(F.col("n_name"), F.lit(" Province")).alias("StateProvinceName"),
            F.col("n_regionkey").alias("CountryID"),
        )

    @cached_property
    def countries(self) -> DataFrame:
        return self._t("region").select(
            F.col("r_regionkey").alias("CountryID"),
            F.col("r_name").alias("CountryName"),
            F.concat(F.lit("Formal "), F.col("r_name")).alias("FormalName"),
        )

    # -- customers -------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        return self._t("customer").select(
            F.col("c_custkey").alias("CustomerID"),
            F.col("c_name").alias("CustomerName"),
            F.col("c_mktsegment").alias("CustomerCategoryID"),
            F.col("c_nationkey").alias("DeliveryCityID"),
            ((F.col("c_nationkey") + 7) % 25).alias("PostalCityID"),
        )

    @cached_property
    def customer_categories(self) -> DataFrame:
        return (
            self._t("customer")
            .select(F.col("c_mktsegment").alias("CustomerCategoryID"))
            .distinct()
            .withColumn("CustomerCategoryName", F.col("CustomerCategoryID"))
        )

    # -- products --------------------------------------------------------
    @cached_property
    def stock_items(self) -> DataFrame:
        return self._t("part").select(
            F.col("p_partkey").alias("StockItemID"),
            F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("StockItemName"),
            F.col("p_brand").alias("Brand"),
            F.col("p_size").cast("string").alias("Size"),
            F.substring_index(F.col("p_name"), " ", 1).alias("ColorID"),
        )

    @cached_property
    def colors(self) -> DataFrame:
        return (
            self._t("part")
            .select(F.substring_index(F.col("p_name"), " ", 1).alias("ColorID"))
            .distinct()
            .withColumn("ColorName", F.col("ColorID"))
        )

    # -- people ----------------------------------------------------------
    @cached_property
    def people(self) -> DataFrame:
        logon = F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit(".")))
        nation = F.col("s_nationkey").cast("string")
        key = F.col("s_suppkey").cast("string")
        return self._t("supplier").select(
            F.col("s_suppkey").alias("PersonID"),
            F.col("s_name").alias("FullName"),
            F.replace(F.col("s_name"), F.lit("Supplier#"), F.lit("S")).alias("PreferredName"),
            logon.alias("LogonName"),
            F.concat(F.lit('{"nation": '), nation, F.lit("}")).alias("CustomFields"),
            F.concat(F.lit("("), nation, F.lit(") 555-"), key).alias("PhoneNumber"),
            F.concat(F.lit("("), nation, F.lit(") 556-"), key).alias("FaxNumber"),
            F.concat(logon, F.lit("@example.com")).alias("EmailAddress"),
            F.when(F.col("s_suppkey") % 2 == 0, F.lit(1)).otherwise(F.lit(0)).alias("IsSalesperson"),
        )

    # -- orders ----------------------------------------------------------
    def orders(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """Orders, optionally restricted to ``start <= OrderDate <= end``.

        The range is applied to the raw timestamp column so parquet receives it
        as a pushed filter (row-group pruning) instead of a post-scan cast.
        """
        raw = self._t("orders")
        # String literals cast to timestamp_ntz: no session or process time zone is involved.
        if start is not None:
            raw = raw.filter(F.col("o_orderdate") >= F.lit(f"{start} 00:00:00").cast("timestamp_ntz"))
        if end is not None:
            nxt = end + dt.timedelta(days=1)
            raw = raw.filter(F.col("o_orderdate") < F.lit(f"{nxt} 00:00:00").cast("timestamp_ntz"))
        # One-row aggregate: exactly one row, so broadcasting it is bounded.
        n_sup = self._t("supplier").agg(F.count(F.lit(1)).alias("_n_sup"))
        n = F.col("_n_sup")
        return raw.crossJoin(single_row_broadcast(n_sup)).select(
            F.col("o_orderkey").alias("OrderID"),
            F.col("o_orderdate").cast("date").alias("OrderDate"),
            F.col("o_custkey").alias("CustomerID"),
            ((F.col("o_custkey") % 50) * 2 % n).alias("SalespersonPersonID"),
            F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("long"))
            .otherwise(F.col("o_orderkey") % n)
            .alias("PickedByPersonID"),
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        qty = F.col("l_quantity").cast("int")
        return (
            self._t("lineitem")
            .select(
                F.col("l_orderkey").alias("OrderID"),
                F.col("l_linenumber").alias("LineNumber"),
                F.col("l_partkey").alias("StockItemID"),
                qty.alias("Quantity"),
                cents_of(F.col("l_extendedprice")).alias("_cents"),
                (F.col("l_tax") * 100).cast("decimal(18,3)").alias("TaxRate"),
            )
            .withColumn("UnitPrice", unit_price(F.col("_cents"), F.col("Quantity")))
            .drop("_cents")
        )

    def lines(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """Order lines, at least those of the orders of a date range (here all: lines carry no date)."""
        return self.order_lines


def unit_price(cents: Column, qty: Column) -> Column:
    """cents / qty rounded half-up to whole cents, as decimal(18,2) (exact, no float step)."""
    return F.when(qty > 0, (half_up_quotient(cents, qty).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(
        "decimal(18,2)"))

