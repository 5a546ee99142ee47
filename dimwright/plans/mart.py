"""The star-schema mart: dimension specs, calendar, SCD inputs, fact build,
daily incremental run and the summary over the built mart.

Surrogate keys are BIGINT (the reference declares INT): at the target scale a
customer or product count can pass 2^31.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimwright.functions.dates import calendar_columns, date_key
from dimwright.functions.measures import total_after_tax, total_before_tax
from dimwright.operators import digests, quality, scd, scd_history
from dimwright.operators.joins import asof_lookup, key_lookup, single_row_broadcast, versions_by_id
from dimwright.operators.keys import materialize, max_key, with_dense_keys
from dimwright.operators.load import Mart, as_date, as_key, date_ranges, upsert_by_key, write_guarded
from dimwright.plans import extract as ex
from dimwright.plans.schemas import SCHEMAS, conform
from dimwright.session import scratch
from dimwright.sources.oltp import Oltp

UNKNOWN_KEY = -1


@dataclass(frozen=True)
class DimSpec:
    name: str
    key_col: str
    business_key: tuple[str, ...]
    attrs: tuple[str, ...]
    stage_to_dim: dict[str, str] = field(default_factory=dict)
    type2: bool = False

    @property
    def columns(self) -> list[str]:
        cols = [self.key_col, *self.business_key, *self.attrs]
        return cols + (["StartDate", "EndDate"] if self.type2 else [])

    def schema(self) -> T.StructType:
        fields = [T.StructField(self.key_col, T.LongType(), False)]
        fields += [T.StructField(c, T.StringType()) for c in (*self.business_key, *self.attrs)]
        if self.type2:
            fields += [T.StructField("StartDate", T.DateType()), T.StructField("EndDate", T.DateType())]
        return T.StructType(fields)

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema())


CITIES = DimSpec(
    "dim_cities", "CityKey", ("CityName", "StateProvName", "CountryName"), ("StateProvCode", "CountryFormalName"),
    {"DeliveryCityName": "CityName", "DeliveryStateProvinceCode": "StateProvCode",
     "DeliveryStateProvinceName": "StateProvName", "DeliveryCountryName": "CountryName",
     "DeliveryFormalName": "CountryFormalName"},
)
SALESPEOPLE = DimSpec(
    "dim_salespeople", "SalespersonKey", ("LogonName",),
    ("FullName", "PreferredName", "PhoneNumber", "FaxNumber", "EmailAddress"),
)
CUSTOMERS = DimSpec(
    "dim_customers", "CustomerKey", ("CustomerName",),
    ("CustomerCategoryName", "DeliveryCityName", "DeliveryStateProvCode", "DeliveryCountryName",
     "PostalCityName", "PostalStateProvCode", "PostalCountryName"),
    {"CustomerName": "CustomerName", "CustomerCategoryName": "CustomerCategoryName",
     "DeliveryCityName": "DeliveryCityName", "DeliveryStateProvinceCode": "DeliveryStateProvCode",
     "DeliveryCountryName": "DeliveryCountryName", "PostalCityName": "PostalCityName",
     "PostalStateProvinceCode": "PostalStateProvCode", "PostalCountryName": "PostalCountryName"},
    type2=True,
)
PRODUCTS = DimSpec(
    "dim_products", "ProductKey", ("ProductName",), ("ProductColour", "ProductBrand", "ProductSize"), type2=True,
)
PICKING_STAFF = DimSpec(
    "dim_picking_staff", "PickingStaffKey", ("LogonName",),
    ("FullName", "PreferredName", "CustomFields", "PhoneNumber", "FaxNumber", "EmailAddress"), type2=True,
)
FACT_COLUMNS = (
    "CustomerKey", "CityKey", "ProductKey", "SalespersonKey", "DateKey", "PickingStaffKey",
    "Quantity", "UnitPrice", "TaxRate", "TotalBeforeTax", "TotalAfterTax",
)


def in_parallel(tasks: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Run independent driver-side steps (each submitting its own Spark jobs)
    from a small thread pool; Spark schedules the concurrent jobs together."""
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        futures = {k: pool.submit(fn) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def _stage_for(spec: DimSpec, stage: DataFrame) -> DataFrame:
    """Rename stage columns to dimension names (no-op if already renamed)."""
    if spec.stage_to_dim and set(spec.stage_to_dim) <= set(stage.columns):
        return stage.select(*[F.col(s).alias(d) for s, d in spec.stage_to_dim.items()])
    return stage


def apply_scd1(spec: DimSpec, stage: DataFrame, dim: DataFrame) -> DataFrame:
    return scd.scd1(_stage_for(spec, stage), dim, list(spec.business_key), list(spec.attrs), spec.key_col)


def apply_scd2(spec: DimSpec, stage: DataFrame, dim: DataFrame, start, end, null_safe: bool = True,
               report: dict | None = None) -> DataFrame:
    (key,) = spec.business_key
    return scd.scd2(_stage_for(spec, stage), dim, key, list(spec.attrs), spec.key_col, start, end,
                    null_safe=null_safe, report=report)


def scd2_branches(spec: DimSpec, stage: DataFrame, dim: DataFrame, start, end) -> dict[str, DataFrame]:
    (key,) = spec.business_key
    return scd.scd2_branches(_stage_for(spec, stage), dim, key, list(spec.attrs), spec.key_col, start, end)


# -- calendar -----------------------------------------------------------------
def first_order_date(src: Oltp) -> dt.date:
    """The earliest order date (a single scalar)."""
    return order_date_bounds(src)[0]


def order_date_bounds(src: Oltp) -> tuple[dt.date, dt.date]:
    """(first, last) order date from one aggregate over the date column."""
    row = src.orders().agg(F.min("OrderDate").alias("lo"), F.max("OrderDate").alias("hi")).first()
    return row["lo"], row["hi"]


def dim_date_between(spark: SparkSession, start, end) -> DataFrame:
    """DimDate rows for every day in [start, end]."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).alias("d")
    )
    return days.select(*calendar_columns(F.col("d")))


def dim_date_for_orders(src: Oltp) -> DataFrame:
    """DimDate rows covering the whole order date range (one row per day)."""
    bounds = src.orders().agg(F.min("OrderDate").alias("lo"), F.max("OrderDate").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


# -- SCD inputs over the driver tables -------------------------------------------
def scd2_fixture(stage_with_id: DataFrame, id_col: str, spec: DimSpec, d0: dt.date) -> tuple[DataFrame, DataFrame]:
    """(dimension before, stage) for a type-2 run starting the day after ``d0``.

    By ``id % 10``: 9 only in the stage (new); 8 only in the dimension
    (missing); 7 first tracked column changed; 6 unchanged plus an older closed
    version; 5 only a closed version, back in the stage; 4 first tracked column
    null in the dimension (a null-to-value change); 3 unchanged, but the stage
    spells the business key in capitals with a trailing blank; others unchanged.
    The dimension's open rows start on ``d0`` and use key ``id + 1``; older
    versions use key ``id + 2 + max(id)``.
    """
    (bk,) = spec.business_key
    first = spec.attrs[0]
    mapping = spec.stage_to_dim or {c: c for c in (*spec.business_key, *spec.attrs)}
    staged = stage_with_id.select(F.col(id_col).alias("_id"), *[F.col(s).alias(d) for s, d in mapping.items()])
    m = F.col("_id") % 10
    day = lambda n: F.lit(str(d0 + dt.timedelta(days=n))).cast("date")
    max_id = staged.agg(F.max("_id").alias("_max_id"))
    base = staged.filter(m != 9).crossJoin(single_row_broadcast(max_id))
    current = base.filter(m != 5).select(
        (F.col("_id") + 1).cast("long").alias(spec.key_col),
        F.col(bk),
        *[
            (F.when(m == 7, F.concat(F.lit("OLD "), F.col(a)))
             .when(m == 4, F.lit(None).cast("string"))
             .otherwise(F.col(a)) if a == first else F.col(a)).alias(a)
            for a in spec.attrs
        ],
        day(0).alias("StartDate"),
        F.lit(None).cast("date").alias("EndDate"),
    )
    older = base.filter(m.isin(5, 6)).select(
        (F.col("_id") + 2 + F.col("_max_id")).cast("long").alias(spec.key_col),
        F.col(bk),
        *[(F.concat(F.lit("PREV "), F.col(a)) if a == first else F.col(a)).alias(a) for a in spec.attrs],
        day(-365).alias("StartDate"),
        day(-1).alias("EndDate"),
    )
    dim = current.unionByName(older)
    spelled = F.when(m == 3, F.concat(F.upper(F.col(bk)), F.lit(" "))).otherwise(F.col(bk)).alias(bk)
    stage = staged.filter(m != 8).select(spelled, *spec.attrs)
    return dim, stage


def scd2_inputs(src: Oltp, which: str) -> tuple[DataFrame, DataFrame, DimSpec, dt.date]:
    d0 = first_order_date(src)
    if which == "customers":
        spec, stage, id_col = CUSTOMERS, ex.extract_customers(src, keep_id=True), "CustomerID"
    elif which == "products":
        spec, stage, id_col = PRODUCTS, ex.extract_products(src, keep_id=True), "StockItemID"
    elif which == "picking_staff":
        spec, stage, id_col = PICKING_STAFF, ex.extract_picking_staff(src, keep_id=True), "PersonID"
    else:
        raise ValueError(which)
    dim, st = scd2_fixture(stage, id_col, spec, d0)
    return dim, st, spec, d0


def scd2_run(src: Oltp, which: str, null_safe: bool = True) -> DataFrame:
    dim, stage, spec, d0 = scd2_inputs(src, which)
    return apply_scd2(spec, stage, dim, d0 + dt.timedelta(days=1), d0, null_safe=null_safe)


# -- fact ------------------------------------------------------------------------
def fact_orders(stage: DataFrame, dims: dict[str, DataFrame], strict: bool = False,
                first_covers_earlier: bool = False) -> DataFrame:
    """Key lookups and measures for staged order lines.

    Type-2 dimensions are joined as of the order date (the version valid on
    that day; with ``first_covers_earlier`` a member's first version also covers
    all earlier days); type-1 ones on the business key.  Lines whose member is unknown
    get key -1 (``strict=True`` drops them instead).  Staged orders without
    lines (null quantity) produce no fact row.
    """
    how = "inner" if strict else "left"
    f = _order_members(stage.filter(F.col("Quantity").isNotNull()), dims, how, first_covers_earlier)
    return _fact_columns(_products(f, dims, how, first_covers_earlier))


ORDER_KEYS = ("CustomerKey", "CityKey", "SalespersonKey", "PickingStaffKey")


def _order_members(f: DataFrame, dims: dict[str, DataFrame], how: str, first_covers_earlier: bool) -> DataFrame:
    """Keys of the members that belong to an order as a whole."""
    f = asof_lookup(f, dims["customers"], ["CustomerName"], ["CustomerName"], "OrderDate",
                    {"CustomerKey": "CustomerKey"}, how, first_covers_earlier)
    f = key_lookup(f, dims["cities"], ["CityName", "StateProvinceName", "CountryName"],
                   ["CityName", "StateProvName", "CountryName"], {"CityKey": "CityKey"}, how)
    f = key_lookup(f, dims["salespeople"], ["LogonName"], ["LogonName"], {"SalespersonKey": "SalespersonKey"}, how)
    return asof_lookup(f, dims["picking_staff"], ["PickingStaffName"], ["LogonName"], "OrderDate",
                       {"PickingStaffKey": "PickingStaffKey"}, how, first_covers_earlier)


def _products(f: DataFrame, dims: dict[str, DataFrame], how: str, first_covers_earlier: bool) -> DataFrame:
    return asof_lookup(f, dims["products"], ["StockItemName"], ["ProductName"], "OrderDate",
                       {"ProductKey": "ProductKey"}, how, first_covers_earlier)


def _fact_columns(f: DataFrame) -> DataFrame:
    return f.select(
        *[F.coalesce(F.col(k), F.lit(UNKNOWN_KEY)).cast("long").alias(k) for k in (*ORDER_KEYS, "ProductKey")],
        date_key(F.col("OrderDate")).alias("DateKey"),
        F.col("Quantity"),
        F.col("UnitPrice"),
        F.col("TaxRate"),
        total_before_tax(F.col("Quantity"), F.col("UnitPrice")).alias("TotalBeforeTax"),
        total_after_tax(F.col("Quantity"), F.col("UnitPrice"), F.col("TaxRate")).alias("TotalAfterTax"),
    ).select(*FACT_COLUMNS)


def fact_of_orders(headers: DataFrame, lines: DataFrame, dims: dict[str, DataFrame], strict: bool = False,
                   first_covers_earlier: bool = False, items: DataFrame | None = None) -> DataFrame:
    """``fact_orders`` from orders and their lines apart: members of an order are looked up once per order.

    Only the product is looked up for each line; lines meet their order's keys in one join.  With
    ``items (StockItemID, StockItemName)`` lines carry the id only: each item meets the versions of its
    product by name once, and lines meet those by id and day.
    """
    how = "inner" if strict else "left"
    h = _order_members(headers, dims, how, first_covers_earlier).select("OrderID", "OrderDate", *ORDER_KEYS)
    f = lines.filter(F.col("Quantity").isNotNull()).join(h, "OrderID")
    if items is None:
        return _fact_columns(_products(f, dims, how, first_covers_earlier))
    versions = versions_by_id(items, "StockItemID", "StockItemName", dims["products"], "ProductName", ["ProductKey"],
                              first_covers_earlier)
    return _fact_columns(asof_lookup(f, versions, ["StockItemID"], ["StockItemID"], "OrderDate",
                                     {"ProductKey": "ProductKey"}, how))


def extract_stages(src: Oltp) -> dict[str, DataFrame]:
    """The four dimension extracts (lazy)."""
    return {
        "customers": ex.extract_customers(src),
        "products": ex.extract_products(src),
        "salespeople": ex.extract_salespeople(src),
        "picking_staff": ex.extract_picking_staff(src),
    }


def build_dimensions(src: Oltp, start: dt.date, current: dict[str, DataFrame] | None = None,
                     materialized: bool = True, stages: dict[str, DataFrame] | None = None,
                     changes: dict[str, bool] | None = None) -> dict[str, DataFrame]:
    """Next version of all five dimensions from fresh extracts.

    ``current`` holds the previous versions keyed like ``SPEC_BY_DIM``
    ("customers", ...; empty on the first load); type-2 changes open on
    ``start`` and close the day before.  With
    ``materialized=False`` the versions stay lazy (the caller writes them).
    ``changes`` (if given) receives, per type-2 dimension, whether its new
    version differs from the current one.
    """
    spark = src.spark
    cur = current or {}
    end = start - dt.timedelta(days=1)
    st = stages or extract_stages(src)

    if not cur:
        # First load: every business key is new.  De-duplicate and number: the
        # numbered frame is a projection of the copy that the numbering wrote,
        # so it needs no second write.  The five are independent: their
        # (small, many) jobs are submitted from parallel threads.
        return in_parallel({k: (lambda k=k: first_load(SPEC_BY_DIM[k], st[STAGE_OF[k]], start))
                            for k in SPEC_BY_DIM})

    def prev(spec: DimSpec) -> DataFrame:
        # ``current`` is keyed like SPEC_BY_DIM ("customers", ...).
        key = next(k for k, v in SPEC_BY_DIM.items() if v is spec)
        return cur[key] if key in cur else spec.empty(spark)

    reports: dict[str, dict] = {"customers": {}, "products": {}, "picking_staff": {}}
    built = {
        "cities": apply_scd1(CITIES, st["customers"], prev(CITIES)),
        "salespeople": apply_scd1(SALESPEOPLE, st["salespeople"], prev(SALESPEOPLE)),
        "customers": apply_scd2(CUSTOMERS, st["customers"], prev(CUSTOMERS), start, end,
                                report=reports["customers"]),
        "products": apply_scd2(PRODUCTS, st["products"], prev(PRODUCTS), start, end, report=reports["products"]),
        "picking_staff": apply_scd2(PICKING_STAFF, st["picking_staff"], prev(PICKING_STAFF), start, end,
                                    report=reports["picking_staff"]),
    }
    if changes is not None:
        changes.update({k: r["changed"] for k, r in reports.items()})
    # Each version is read by several consumers: write it once instead of
    # recomputing extract + SCD joins for each.
    shaped = {k: v.select(*SPEC_BY_DIM[k].columns) for k, v in built.items()}
    if not materialized:
        return shaped
    return in_parallel({k: (lambda v=v: materialize(v)) for k, v in shaped.items()})


SPEC_BY_DIM = {"cities": CITIES, "salespeople": SALESPEOPLE, "customers": CUSTOMERS,
               "products": PRODUCTS, "picking_staff": PICKING_STAFF}
STAGE_OF = {"cities": "customers", "salespeople": "salespeople", "customers": "customers",
            "products": "products", "picking_staff": "picking_staff"}


def first_load(spec: DimSpec, stage: DataFrame, start) -> DataFrame:
    """Version 1 of a dimension: one row per business key, keys 1..n in key order."""
    keys = list(spec.business_key)
    staged = scd.dedupe_by_key(_stage_for(spec, stage), keys, list(spec.attrs)).select(*keys, *spec.attrs)
    numbered = with_dense_keys(staged, keys, spec.key_col, key_type="long")
    if spec.type2:
        numbered = numbered.withColumn("StartDate", F.lit(str(start)).cast("date")).withColumn(
            "EndDate", F.lit(None).cast("date"))
    return numbered.select(*spec.columns)


def initial_fact(src: Oltp, strict: bool = False) -> DataFrame:
    """Fact over every order date, against dimensions first loaded on the first order date."""
    dims = build_dimensions(src, first_order_date(src))
    return fact_of_orders(ex.order_headers(src), src.order_lines, dims, strict, items=ex.item_names(src))


# -- daily run -----------------------------------------------------------------------
def run_dates(src: Oltp, mart: Mart, start: dt.date, end: dt.date, members_as_of_start: bool = False,
              keep_summary: bool = False, late_members: bool = False) -> int:
    """One incremental run for the dates [start, end]; returns the fact rows loaded.

    Order: order extract (guarded: nothing is published if it is empty),
    dimension extracts, dimension transforms, calendar rows, fact build with
    as-of lookups.  Dimensions and fact are written to new folders and made
    current together; every date of the range is replaced, empty ones included.
    Re-running the same dates with an unchanged source changes nothing.

    A run older than the newest dimension version loads facts only: the source
    tells how members are today, not how they were then, so history stays as
    it is.  A member's first version also covers the dates before it.  With
    ``members_as_of_start`` the source tells how they were on ``start``: that state is
    inserted into the history, to hold until the next observed day; loaded facts of that
    span are built anew from the source, and facts of other dates whose
    version got another key are re-keyed, date by date.

    ``keep_summary`` also writes the run's part of ``kept_summary``.  With ``late_members`` a run
    remembers, per date, the ids of customers and products that its orders name and the source does
    not have (their lines get key -1); a later run builds the dates anew whose ids have turned up, and no others.
    """
    spark = src.spark
    with scratch(spark):
        def stage(name: str, df: DataFrame, guarded: bool = True, folder: str | None = None) -> DataFrame:
            path = f"{mart.root}/_stage/{folder or name}"
            df = conform(df, SCHEMAS[f"{name}_stage"])
            if guarded:
                write_guarded(df, path, name=name)
            else:
                df.write.mode("overwrite").parquet(path)
            return spark.read.schema(df.schema).parquet(path)

        orders = _staged_orders(src, start, end, stage)
        mart._load_manifest()
        current = {k: mart.read(spec.name) for k, spec in SPEC_BY_DIM.items() if mart.has(spec.name)}
        until = mart.next_observed(start) if members_as_of_start and current else None
        late = until is not None or any(
            scd.is_backdated(current[k], start) for k, spec in SPEC_BY_DIM.items() if spec.type2 and k in current)
        after: dict[str, DataFrame] = {}
        moved: dict[str, DataFrame] = {}
        if until is not None:
            after, moved = _inserted_dimensions(src, start, until, current, stage)
        elif not late:
            after = _changed_dimensions(src, mart, start, current, stage)
        calendar = mart.upserted("dim_date", dim_date_between(spark, start, end), "DateKey")
        if calendar is not None:
            after["dim_date"] = calendar
        rows = mart.write_versions({t: conform(df, SCHEMAS[t]) if t in SCHEMAS else df for t, df in after.items()})
        written = mart.read_written(rows)
        dims = {k: written.get(spec.name, current.get(k)) for k, spec in SPEC_BY_DIM.items()}
        fact = orders.fact(dims)
        ranges = [(as_key(start), as_key(end))]
        due: list[int] = []
        others: list[int] = []
        if late_members:
            due = _dates_due(src, mart, start, end)
        anew = set(due)
        if until is not None:
            again, others = _dates_concerned(mart, start, end, until, moved)
            anew |= set(again)
            others = [k for k in others if k not in anew]
        extracts = [orders]
        if anew:
            extracts.append(_orders_again(src, sorted(anew), orders, stage))
            fact = fact.unionByName(extracts[-1].fact(dims))
            ranges += date_ranges(sorted(anew))
        if until is not None:
            if others:
                loaded = mart.read_fact(others[0], others[-1]).where(F.col("DateKey").isin(others))
                for key_col, spans in moved.items():
                    loaded = scd_history.rekey(loaded, spans, key_col)
                fact = fact.unionByName(loaded.select(*FACT_COLUMNS))
            ranges += date_ranges(others)
        fact_rows, n = mart.write_run(conform(fact, SCHEMAS["fact_orders"]), ranges)
        observed = [] if late and until is None else mart.observed_on(start)
        parts = mart.write_parts(SALES, fact_rows, _sales_parts(mart.written_load(fact_rows))) if keep_summary else []
        if late_members:
            parts += mart.write_parts(UNRESOLVED, fact_rows, _unresolved(extracts, start, end, due))
        mart.commit(rows + fact_rows + observed + parts)
    return n


class StagedOrders(NamedTuple):
    """The orders extract as a run stages it: what belongs to an order once per order, its lines apart."""

    headers: DataFrame
    lines: DataFrame
    items: DataFrame

    def fact(self, dims: dict[str, DataFrame]) -> DataFrame:
        return fact_of_orders(self.headers, self.lines, dims, first_covers_earlier=True, items=self.items)


def _staged_orders(src: Oltp, start: dt.date, end: dt.date, stage: Callable[..., DataFrame]) -> StagedOrders:
    """Orders (guarded), their lines and the items of [start, end], each written once."""
    headers = stage("order_headers", ex.order_headers(src, start, end))
    rest = in_parallel({
        "lines": lambda: stage("order_lines", ex.lines_of(src, headers, start, end), guarded=False),
        "items": lambda: stage("stock_items", ex.item_names(src), guarded=False)})
    return StagedOrders(headers, **rest)


def _orders_again(src: Oltp, keys: list[int], own: StagedOrders, stage: Callable[..., DataFrame]) -> StagedOrders:
    """The orders of some other date keys (sorted), staged beside the run's ``own``; they may be gone by now."""
    first, last = as_date(keys[0]), as_date(keys[-1])
    wanted = ex.order_headers(src, first, last).where(date_key(F.col("OrderDate")).isin(keys))
    headers = stage("order_headers", wanted, guarded=False, folder="order_headers_again")
    lines = stage("order_lines", ex.lines_of(src, headers, first, last), guarded=False, folder="order_lines_again")
    return StagedOrders(headers, lines, own.items)


#: Ids that a load's orders name without a member, per date.
UNRESOLVED = "unresolved_members"


def _unresolved(extracts: list[StagedOrders], start: dt.date, end: dt.date, due: list[int]) -> DataFrame:
    """(MEMBER, SourceID, DateKey) of customers and products that orders of [start, end] and of ``due`` name in vain.

    Read from the staged ``extracts``: the missing items are found among the distinct ids, so only lines that
    name one of them meet their order.
    """
    key = date_key(F.col("OrderDate"))
    parts = []
    for e in extracts:
        h = e.headers.select("OrderID", "CustomerID", "CustomerName", key.alias("DateKey"))
        h = h.where(F.col("DateKey").between(as_key(start), as_key(end)) | F.col("DateKey").isin(due))
        parts.append(h.where("CustomerName is null and CustomerID is not null").select(
            F.lit("customers").alias("MEMBER"), F.col("CustomerID").alias("SourceID"), "DateKey"))
        ids = e.lines.select("StockItemID").dropna().distinct()
        missing = materialize(ids.join(e.items.where("StockItemName is not null"), "StockItemID", "left_anti"))
        lines = e.lines.select("OrderID", "StockItemID").join(missing, "StockItemID", "left_semi")
        parts.append(lines.join(h, "OrderID").select(
            F.lit("products").alias("MEMBER"), F.col("StockItemID").alias("SourceID"), "DateKey"))
    return reduce(DataFrame.unionByName, parts).distinct()


def _dates_due(src: Oltp, mart: Mart, start: dt.date, end: dt.date) -> list[int]:
    """Loaded dates outside [start, end] whose missing members the source has by now (one row per day comes back)."""
    if not mart.has(UNRESOLVED):
        return []
    waiting = mart.read_parts(UNRESOLVED)
    waiting = waiting.where(~F.col("DateKey").between(as_key(start), as_key(end)))
    there = src.customers.select(F.lit("customers").alias("MEMBER"), F.col("CustomerID").alias("SourceID")).unionByName(
        src.stock_items.select(F.lit("products").alias("MEMBER"), F.col("StockItemID").alias("SourceID")))
    found = waiting.join(there, ["MEMBER", "SourceID"], "left_semi").select("DateKey").distinct()
    return sorted(r["DateKey"] for r in found.collect())


def _inserted_dimensions(
    src: Oltp, start: dt.date, until: dt.date, current: dict[str, DataFrame],
    stage: Callable[[str, DataFrame], DataFrame],
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(table -> next version, key column -> moved spans) with the members of ``start`` inserted until ``until``.

    Type 1 holds the newest values, so older ones only add members that are not known yet.
    """
    stages = in_parallel({n: (lambda n=n, df=df: stage(n, df)) for n, df in extract_stages(src).items()})
    after: dict[str, DataFrame] = {}
    moved: dict[str, DataFrame] = {}
    for k, spec in SPEC_BY_DIM.items():
        members = _stage_for(spec, stages[STAGE_OF[k]])
        if spec.type2:
            (key,) = spec.business_key
            after[spec.name], spans = scd_history.scd2_insert(
                members, current[k], key, list(spec.attrs), spec.key_col, start, until)
            moved[spec.key_col] = materialize(spans)
        else:
            known = apply_scd1(spec, members, current[k])
            fresh = known.join(current[k].select(spec.key_col), spec.key_col, "left_anti")
            after[spec.name] = current[k].unionByName(fresh.select(*current[k].columns))
    return after, moved


def _dates_concerned(mart: Mart, start: dt.date, end: dt.date, until: dt.date,
                     moved: dict[str, DataFrame]) -> tuple[list[int], list[int]]:
    """Loaded date keys beyond [start, end]: those before ``until``, and others on which a key moved.

    One row per calendar day comes to the driver.
    """
    loaded = mart.fact_index().select("DateKey")
    days = [r["DateKey"] for r in loaded.collect()]
    own = range(as_key(start), as_key(end) + 1)
    again = sorted(k for k in days if as_key(start) < k < as_key(until) and k not in own)
    last = F.lit(str(as_date(max(days, default=as_key(end))))).cast("date")
    spans = reduce(DataFrame.unionByName, [m.select("FirstDay", "LastDay") for m in moved.values()]).distinct()
    spans = spans.select("FirstDay", F.least(F.coalesce("LastDay", last), last).alias("to")).where("FirstDay <= to")
    on = spans.select(F.explode(F.sequence("FirstDay", "to")).alias("day")).select(
        date_key(F.col("day")).alias("DateKey")).distinct()
    others = sorted(r["DateKey"] for r in on.join(loaded, "DateKey").collect())
    return again, [k for k in others if k not in own and k not in set(again)]


def _digest_table(spec: DimSpec) -> str:
    return f"digest_{spec.name}"


def _member_digests(spec: DimSpec, stage: DataFrame) -> DataFrame:
    return digests.member_digests(_stage_for(spec, stage), list(spec.business_key), list(spec.attrs), spec.type2)


def _changed_dimensions(src: Oltp, mart: Mart, start: dt.date, current: dict[str, DataFrame],
                        stage: Callable[[str, DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """Table name -> complete next version, for the dimensions (and digests) that change on ``start``.

    The digests of the staged members are compared with those of the last run; only members that
    differ meet the dimension, and nothing does if none differs.
    """
    stages = in_parallel({n: (lambda n=n, df=df: stage(n, df)) for n, df in extract_stages(src).items()})
    after: dict[str, DataFrame] = {}
    if not all(k in current and mart.has(_digest_table(spec)) for k, spec in SPEC_BY_DIM.items()):
        after = _whole_dimensions(src, mart, start, current, stages)
        changed = list(SPEC_BY_DIM)
    else:
        members = in_parallel({k: (lambda k=k, spec=spec: materialize(digests.digest_diff(
            mart.read(_digest_table(spec)), _member_digests(spec, stages[STAGE_OF[k]])))) for k, spec in SPEC_BY_DIM.items()})
        changed = [k for k, diff in members.items() if not diff.isEmpty()]
        for k in changed:
            after[SPEC_BY_DIM[k].name] = _with_members(SPEC_BY_DIM[k], stages[STAGE_OF[k]], current[k], members[k], start)
    return after | {_digest_table(SPEC_BY_DIM[k]): _member_digests(SPEC_BY_DIM[k], stages[STAGE_OF[k]]) for k in changed}


def _with_members(spec: DimSpec, stage: DataFrame, dim: DataFrame, members: DataFrame, start: dt.date) -> DataFrame:
    """The next version of ``dim``: the ``members`` that differ meet their stage rows, all others stay as they are."""
    keys = list(spec.business_key)
    staged, _ = digests.split_by_members(_stage_for(spec, stage), keys, members)
    if not spec.type2:  # a member missing from the stage is kept
        return upsert_by_key(dim, apply_scd1(spec, staged, dim).select(*dim.columns), spec.key_col)
    concerned, others = digests.split_by_members(dim, keys, members)
    (key,) = keys
    highest = max_key(dim, spec.key_col).first()[0]
    met = scd.scd2(staged, concerned, key, list(spec.attrs), spec.key_col, start, start - dt.timedelta(days=1),
                   highest=highest)
    return met.select(*dim.columns).unionByName(others)


def _whole_dimensions(src: Oltp, mart: Mart, start: dt.date, current: dict[str, DataFrame],
                      stages: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """As ``_changed_dimensions`` for a first load, or a mart that has no digests yet: all members meet their dimension.

    Load = upsert by surrogate key (a type-1 member missing from today's stage
    is kept).  A type-2 preload is already the complete next version.
    """
    changes: dict[str, bool] = {}
    preloads = build_dimensions(src, start, current, materialized=False, stages=stages, changes=changes)
    after: dict[str, DataFrame] = {}
    for k, spec in SPEC_BY_DIM.items():
        pre = preloads[k].select(*spec.columns)
        if k not in current:
            after[spec.name] = pre
        elif spec.type2:
            if changes.get(k, True):
                after[spec.name] = pre
        elif (version := mart.upserted(spec.name, pre, spec.key_col)) is not None:
            after[spec.name] = version
    return after


def daily_run(src: Oltp, mart: Mart | None = None) -> DataFrame:
    """First load on the first order date, then one incremental run over every
    later date; returns the whole fact table from the mart."""
    mart = mart or Mart(src.spark)
    d0, last = order_date_bounds(src)
    run_dates(src, mart, d0, d0)
    if last > d0:
        run_dates(src, mart, d0 + dt.timedelta(days=1), last)
    return mart.read_fact()


def mart_summary(fact: DataFrame, customers: DataFrame, calendar: DataFrame) -> DataFrame:
    """Order lines, quantity and taxed revenue per year and customer category.

    The fact is summed per date and customer before it meets the dimensions.
    """
    return _summed_sales(_sales_parts(fact), customers, calendar)


#: Parts of the summary, one per load of the fact.
SALES = "sales_parts"


def _sales_parts(fact: DataFrame) -> DataFrame:
    measures = {"ORDER_LINES": F.count(F.lit(1)), "QUANTITY": F.sum("Quantity"), "REVENUE": F.sum("TotalAfterTax")}
    return fact.groupBy("DateKey", "CustomerKey").agg(*[m.alias(a) for a, m in measures.items()])


def kept_summary(mart: Mart) -> DataFrame:
    """``mart_summary`` of the whole mart from the parts that its runs wrote (``run_dates`` with ``keep_summary``).

    A run sums its own fact rows only.  A date that is loaded again is retracted by the fact's
    index: the parts of its older loads do not count any more.
    """
    return _summed_sales(mart.read_parts(SALES), mart.read(CUSTOMERS.name), mart.read("dim_date"))


def _summed_sales(per_key: DataFrame, customers: DataFrame, calendar: DataFrame) -> DataFrame:
    return (
        per_key.join(calendar.select("DateKey", "Year"), "DateKey", "left")
        .join(customers.select("CustomerKey", "CustomerCategoryName"), "CustomerKey", "left")
        .groupBy("Year", "CustomerCategoryName")
        .agg(
            F.sum("ORDER_LINES").alias("ORDER_LINES"),
            F.sum("QUANTITY").cast("long").alias("QUANTITY"),
            F.sum("REVENUE").cast("decimal(18,2)").alias("REVENUE"),
        )
    )


def sales_by_member(fact: DataFrame, customers: DataFrame, products: DataFrame, cities: DataFrame) -> DataFrame:
    """Order lines and taxed revenue per year and the values of the member versions that the fact points to."""
    year = F.floor(F.col("DateKey") / 10000).cast("int").alias("YEAR")
    per_key = fact.groupBy(year, "CustomerKey", "ProductKey", "CityKey").agg(
        F.count(F.lit(1)).alias("N"), F.sum("TotalAfterTax").alias("R"))
    return (
        per_key.join(customers.select("CustomerKey", "CustomerCategoryName"), "CustomerKey", "left")
        .join(products.select("ProductKey", "ProductBrand"), "ProductKey", "left")
        .join(cities.select("CityKey", "CountryFormalName"), "CityKey", "left")
        .groupBy("YEAR", "CustomerCategoryName", "ProductBrand", "CountryFormalName")
        .agg(F.sum("N").alias("ORDER_LINES"), F.sum("R").cast("decimal(18,2)").alias("REVENUE"))
    )


def required_columns(spec: DimSpec) -> list[str]:
    """Columns that must not be null: the surrogate key and, for type 2, the first day."""
    return [spec.key_col, *(["StartDate"] if spec.type2 else [])]


def mart_nulls(dims: dict[str, DataFrame], calendar: DataFrame, fact: DataFrame) -> DataFrame:
    """(TABLE_NAME, COLUMN_NAME, NULL_COUNT) of the mart's NOT NULL columns."""
    tables = {spec.name: (dims[k], required_columns(spec)) for k, spec in SPEC_BY_DIM.items()}
    tables["dim_date"] = (calendar, list(calendar.columns))
    tables["fact_orders"] = (fact, [c for c in FACT_COLUMNS if c.endswith("Key")])
    return quality.required_nulls(tables)


def check_mart(mart: Mart) -> DataFrame:
    """Quality report over a built mart: (CHECK, TABLE_NAME, KEY_NAME, KEY_VALUE, N).

    Duplicate surrogate keys per dimension, nulls where none may be, and orphan
    foreign keys of the fact (the unknown member -1 shows up here by design), all
    in distributed jobs.
    """
    parts = []
    refs = {}
    dims = {k: mart.read(spec.name) for k, spec in SPEC_BY_DIM.items()}
    for k, spec in SPEC_BY_DIM.items():
        dups = quality.duplicate_keys(dims[k], [spec.key_col])
        parts.append(dups.select(
            F.lit("duplicate_key").alias("CHECK"), F.lit(spec.name).alias("TABLE_NAME"),
            F.lit(spec.key_col).alias("KEY_NAME"), F.col(spec.key_col).cast("long").alias("KEY_VALUE"), F.col("N"),
        ))
        refs[spec.key_col] = (dims[k], spec.key_col)
    calendar, fact = mart.read("dim_date"), mart.read_fact()
    refs["DateKey"] = (calendar, "DateKey")
    parts.append(quality.orphan_keys(fact, refs).select(
        F.lit("orphan_key").alias("CHECK"), F.lit("fact_orders").alias("TABLE_NAME"), "KEY_NAME", "KEY_VALUE", "N",
    ))
    parts.append(mart_nulls(dims, calendar, fact).filter("NULL_COUNT > 0").select(
        F.lit("null_value").alias("CHECK"), "TABLE_NAME", F.col("COLUMN_NAME").alias("KEY_NAME"),
        F.lit(None).cast("long").alias("KEY_VALUE"), F.col("NULL_COUNT").alias("N"),
    ))
    return reduce(DataFrame.unionByName, parts)
