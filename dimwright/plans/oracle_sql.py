"""DuckDB SQL oracles, one per registered query (same output column names).

Written from the operator definitions, independently of the Spark code.  The
listing and the order-database views are rebuilt here as CTEs over the
driver's tables.  Exact half-up rounding of ratios uses integer arithmetic.
"""

from __future__ import annotations

SQL: dict[str, str] = {}


def sql(key: str, text: str) -> None:
    if key in SQL:
        raise ValueError(f"duplicate oracle {key}")
    SQL[key] = text.strip()


def ratio(num: str, den: str, digits: int, precision: int = 18) -> str:
    """num / den rounded half away from zero to ``digits`` decimals (integers in).

    Whole part by integer division, then one more unit when the remainder is at
    least half of the divisor.
    """
    n = f"(abs(CAST({num} AS HUGEINT)) * {10 ** digits})"
    whole = f"({n} // ({den}) + CASE WHEN 2 * ({n} % ({den})) >= ({den}) THEN 1 ELSE 0 END)"
    signed = f"(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END) * {whole}"
    unit = "1" if digits == 0 else "0." + "0" * (digits - 1) + "1"
    return (f"CASE WHEN ({den}) > 0 THEN CAST(CAST({signed} AS DECIMAL(18,0)) * {unit} "
            f"AS DECIMAL({precision},{digits})) END")


def pct(part: str, whole: str, digits: int = 2) -> str:
    return ratio(f"CAST({part} AS BIGINT) * 100", whole, digits)


HOME = "asia"
FOCUS = "Brand#2"
# The junk country codes of the cleaning step.
JUNK = "(' Bar', ' Grill', ' Bakers & More\"', ' Chowringhee Lane\"', ' Grill & Bar\"', ' Chinese')"

RAW = """raw AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS RestaurantID,
         CAST(p.p_partkey % 5 AS VARCHAR) AS CountryCode,
         p.p_type AS City,
         p.p_brand || ' Road ' || CAST(p.p_partkey AS VARCHAR) AS Address,
         p.p_brand AS Locality,
         p.p_brand || ', ' || p.p_type AS LocalityVerbose,
         replace(p.p_name, ' ', '|') AS Cuisines,
         'CUR' || CAST(p.p_partkey % 5 AS VARCHAR) AS Currency,
         CASE WHEN p.p_partkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS Has_Table_booking,
         CASE WHEN p.p_partkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS Has_Online_delivery,
         CASE WHEN p.p_partkey % 7 = 0 THEN 'Yes' ELSE 'No' END AS Is_delivering_now,
         'No' AS Switch_to_order_menu,
         CAST(p.p_partkey % 4 + 1 AS VARCHAR) AS Price_range,
         CAST(coalesce(v.n, 0) AS VARCHAR) AS Votes,
         CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS Average_Cost_for_two,
         CAST(CAST(p.p_size / 10 AS DECIMAL(3,1)) AS VARCHAR) AS Rating
  FROM part p
  LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) v ON p.p_partkey = v.l_partkey
)"""

# The limits and names of the rating bands.
BAND = """CASE WHEN {r} >= 1 AND {r} < 2.5 THEN 'POOR'
            WHEN {r} >= 2.5 AND {r} < 3.5 THEN 'GOOD'
            WHEN {r} >= 3.5 AND {r} < 4.5 THEN 'GREAT'
            WHEN {r} >= 4.5 THEN 'EXCELLENT' END"""

CLEAN = RAW + """,
country AS (SELECT CAST(r_regionkey AS VARCHAR) AS COUNTRYCODE, r_name AS COUNTRY FROM region),
clean AS (
  SELECT r.RestaurantID, r.CountryCode,
         CASE WHEN r.City LIKE '%?%' THEN replace(r.City, '?', 'i') ELSE r.City END AS City,
         r.Locality, r.Cuisines, r.Currency, r.Has_Table_booking, r.Has_Online_delivery, r.Is_delivering_now,
         CAST(r.Price_range AS INTEGER) AS Price_range,
         CAST(r.Votes AS INTEGER) AS Votes,
         CAST(r.Average_Cost_for_two AS DOUBLE) AS Average_Cost_for_two,
         CAST(r.Rating AS DECIMAL(3,1)) AS Rating,
         c.COUNTRY AS COUNTRY_NAME,
         """ + BAND.format(r="CAST(r.Rating AS DECIMAL(3,1))") + """ AS RATE_CATEGORY
  FROM raw r
  LEFT JOIN (SELECT COUNTRYCODE, min(COUNTRY) AS COUNTRY FROM country GROUP BY COUNTRYCODE) c
    ON r.CountryCode = c.COUNTRYCODE
  WHERE NOT coalesce(r.CountryCode IN """ + JUNK + """, false)
    AND NOT coalesce(r.RestaurantID = '18306543', false)
)"""

GAPS = """gaps AS (
  SELECT *  REPLACE (CASE WHEN Locality = 'Brand#2' THEN NULL WHEN Locality = 'Brand#3' THEN ' '
                          WHEN Locality = 'Brand#4' THEN '' ELSE Cuisines END AS Cuisines)
  FROM raw)"""
QMARK = """qm AS (SELECT * REPLACE (replace(City, 'I', '?') AS City) FROM raw)"""

W_RAW = "WITH " + RAW
W_CLEAN = "WITH " + CLEAN

LOCALITY_COUNTS = f"""sized AS (
  SELECT COUNTRY_NAME, City, Locality, count(RestaurantID) AS REST_COUNT,
         rank() OVER (ORDER BY count(RestaurantID) DESC) AS from_top,
         rank() OVER (ORDER BY count(RestaurantID)) AS from_bottom
  FROM clean WHERE lower(COUNTRY_NAME) = '{HOME}'
  GROUP BY ALL),
winners AS (SELECT COUNTRY_NAME, City, Locality, REST_COUNT FROM sized WHERE from_top = 1),
winner_rows AS (SELECT clean.* FROM clean SEMI JOIN winners USING (COUNTRY_NAME, City, Locality))"""

# -- scans / catalog ----------------------------------------------------------
sql("scan_full", W_CLEAN + " SELECT * FROM clean")
sql("view_total_count", W_CLEAN + """
SELECT DISTINCT COUNTRY_NAME, count(CAST(RestaurantID AS DECIMAL(18,0))) OVER () AS TOTAL_REST FROM clean""")
sql("cte_chain", W_CLEAN + ", " + LOCALITY_COUNTS + """
SELECT Locality, REST_COUNT, Cuisines FROM winner_rows JOIN winners USING (COUNTRY_NAME, City, Locality)""")
TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations")


def profile(tables: tuple[str, ...]) -> str:
    counts = " UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS n FROM {t}" for t in tables)
    return f"""
SELECT table_name AS TABLE_NAME, column_name AS COLUMN_NAME, CAST(ordinal_position AS INTEGER) AS ORDINAL_POSITION,
       data_type AS DATA_TYPE, n AS TABLE_ROWS
FROM information_schema.columns JOIN ({counts}) c ON c.t = table_name"""


sql("profile_columns", profile(("part",)))
sql("profile_tables", profile(TABLE_NAMES))

# -- projection / filters / column maintenance ----------------------------------
sql("project_rename", W_CLEAN + """
SELECT RestaurantID AS ListingId, COUNTRY_NAME AS Country, City, Locality AS Area, Cuisines AS Menu FROM clean""")
sql("project_literals", W_CLEAN + """
SELECT RestaurantID, 'WITH_TABLE' AS TABLE_BOOKING_OPT, DATE '2013-01-01' AS StartDate, CAST(NULL AS DATE) AS EndDate
FROM clean""")
sql("filter_eq_ci", W_CLEAN + f"""
SELECT RestaurantID, COUNTRY_NAME, City, Locality FROM clean WHERE lower(COUNTRY_NAME) = '{HOME}'""")
sql("filter_range", W_CLEAN + " SELECT RestaurantID, Rating, Price_range FROM clean WHERE Rating >= 4.5")
BEST = f"""lower(COUNTRY_NAME) = '{HOME}' AND lower(Has_Table_booking) = 'yes' AND lower(Has_Online_delivery) = 'yes'
  AND Price_range <= 3 AND Votes > 20 AND Average_Cost_for_two < 990 AND Rating > 4 AND Cuisines ILIKE '%e%'"""
sql("filter_conjunction", W_CLEAN + f" SELECT RestaurantID, Votes, Rating, Cuisines FROM clean WHERE {BEST}")
sql("filter_disjunction", W_CLEAN + """
SELECT RestaurantID, Has_Table_booking, Has_Online_delivery FROM clean
WHERE lower(Has_Table_booking) = 'yes' OR lower(Has_Online_delivery) = 'yes'""")
sql("remove_in_list", W_RAW + """
SELECT RestaurantID, nullif(CountryCode, '4') AS CountryCode FROM raw
WHERE NOT coalesce(nullif(CountryCode, '4') IN """ + JUNK + """ OR nullif(CountryCode, '4') IN ('1', '2'), false)""")
sql("remove_by_key", W_RAW + " SELECT RestaurantID, City FROM raw WHERE NOT coalesce(RestaurantID = '7', false)")
sql("filter_null_or_blank", W_RAW + ", " + GAPS + """
SELECT RestaurantID, Cuisines FROM gaps WHERE Cuisines IS NULL OR rtrim(Cuisines) = ''""")
sql("filter_like", W_CLEAN + " SELECT RestaurantID, Cuisines FROM clean WHERE Cuisines ILIKE '%RING%'")
sql("distinct_values", W_CLEAN + " SELECT DISTINCT City FROM clean")
sql("distinct_multi", W_CLEAN + " SELECT DISTINCT COUNTRY_NAME, City FROM clean")
sql("add_column", W_RAW + " SELECT RestaurantID, CAST(NULL AS VARCHAR) AS COUNTRY_NAME FROM raw")
sql("drop_columns", W_RAW + " SELECT * EXCLUDE (Address, LocalityVerbose, Switch_to_order_menu) FROM raw")
sql("retype_columns", W_RAW + """
SELECT RestaurantID, CAST(Votes AS INTEGER) AS Votes, CAST(Price_range AS INTEGER) AS Price_range,
       CAST(Average_Cost_for_two AS DOUBLE) AS Average_Cost_for_two, CAST(Rating AS DECIMAL(3,1)) AS Rating
FROM raw""")
sql("update_where", W_RAW + ", " + QMARK + """
SELECT RestaurantID, CASE WHEN City LIKE '%?%' THEN replace(City, '?', 'i') ELSE City END AS City FROM qm""")
sql("update_case", W_RAW + """
SELECT RestaurantID, CAST(Rating AS DECIMAL(3,1)) AS Rating, """
    + BAND.format(r="CAST(Rating AS DECIMAL(3,1))") + """ AS RATE_CATEGORY FROM raw""")
sql("update_from_lookup", W_RAW + """
SELECT r.RestaurantID, r.CountryCode, c.COUNTRY AS COUNTRY_NAME
FROM raw r LEFT JOIN (SELECT CAST(r_regionkey AS VARCHAR) AS COUNTRYCODE, min(r_name) AS COUNTRY
                      FROM region GROUP BY 1) c ON r.CountryCode = c.COUNTRYCODE""")

# -- joins (listing side) -----------------------------------------------------
sql("join_inner", W_RAW + """
SELECT r.RestaurantID, r.CountryCode, g.r_name AS COUNTRY
FROM raw r JOIN region g ON r.CountryCode = CAST(g.r_regionkey AS VARCHAR)""")
sql("join_aggregate_back", W_CLEAN + """
SELECT l.RestaurantID, l.COUNTRY_NAME, l.City, c.CITY_REST
FROM clean l JOIN (SELECT COUNTRY_NAME, City, count(RestaurantID) AS CITY_REST FROM clean GROUP BY 1, 2) c
  ON l.COUNTRY_NAME = c.COUNTRY_NAME AND l.City = c.City""")
sql("winner_group_rows", W_CLEAN + ", " + LOCALITY_COUNTS + " SELECT RestaurantID, City, Locality FROM winner_rows")
sql("lateral_split", W_CLEAN + """
SELECT COUNTRY_NAME, City, Locality, unnest(string_split(Cuisines, '|')) AS Cuisines FROM clean""")

# -- aggregation ----------------------------------------------------------------
sql("dup_key_counts", W_RAW + " SELECT RestaurantID, count(RestaurantID) AS N FROM raw GROUP BY RestaurantID")
sql("value_counts", W_CLEAN + " SELECT Cuisines, count(Cuisines) AS N FROM clean GROUP BY Cuisines")
sql("blank_counts", W_RAW + ", " + GAPS + """
SELECT Cuisines, count(Cuisines) AS N FROM gaps WHERE Cuisines IS NULL OR rtrim(Cuisines) = '' GROUP BY Cuisines""")
sql("group_count_multi", W_CLEAN + """
SELECT COUNTRY_NAME, City, Locality, count(Locality) AS TOTAL_REST FROM clean GROUP BY 1, 2, 3""")
sql("stats_global", W_CLEAN + """
SELECT min(Votes) AS MIN_VT, CAST(sum(Votes) // count(Votes) AS INTEGER) AS AVG_VT, max(Votes) AS MAX_VT
FROM clean""")
sql("stats_by_group", W_CLEAN + """
, c AS (SELECT Currency, CAST(trunc(Average_Cost_for_two) AS INTEGER) AS v FROM clean)
SELECT Currency, min(v) AS MIN_CST, CAST(sum(v) // count(v) AS INTEGER) AS AVG_CST, max(v) AS MAX_CST
FROM c GROUP BY Currency""")
sql("rating_stats", W_CLEAN + f"""
SELECT min(Rating) AS MIN_RATING,
       {ratio("sum(CAST(CAST(Rating AS DECIMAL(18,0)) AS BIGINT))", "count(Rating)", 1)} AS AVG_RATING,
       max(Rating) AS MAX_RATING
FROM clean""")
LOCATION = W_CLEAN + f"""
SELECT COUNTRY_NAME, City, Locality, count(RestaurantID) AS TOTAL_REST,
       {ratio("sum(CAST(CAST(Rating AS DECIMAL(18,0)) AS BIGINT))", "count(Rating)", 2)} AS AVG_RATING
FROM clean GROUP BY COUNTRY_NAME, City, Locality"""
sql("avg_rating_by_location", LOCATION)
HIGH_RATED = W_CLEAN + """
SELECT Price_range, count(Has_Table_booking) AS NO_OF_REST FROM clean
WHERE Rating >= 4.5 AND lower(Has_Table_booking) = 'yes' GROUP BY Price_range"""
sql("filtered_group_count", HIGH_RATED)
SHARE = W_CLEAN + f"""
, per AS (SELECT COUNTRY_NAME, count(CAST(RestaurantID AS DECIMAL(18,0))) AS REST_COUNT FROM clean GROUP BY 1),
tot AS (SELECT count(CAST(RestaurantID AS DECIMAL(18,0))) AS t FROM clean)
SELECT per.COUNTRY_NAME, per.REST_COUNT, {pct("per.REST_COUNT", "tot.t")} AS PCT
FROM per, tot WHERE per.COUNTRY_NAME IS NOT NULL"""
sql("share_of_total", SHARE)
ONLINE = W_CLEAN + f"""
, g AS (SELECT COUNTRY_NAME, count(RestaurantID) AS n FROM clean GROUP BY 1)
SELECT a.COUNTRY_NAME, count(a.RestaurantID) AS TOTAL_REST, {pct("count(a.RestaurantID)", "g.n")} AS PCT
FROM clean a JOIN g ON a.COUNTRY_NAME = g.COUNTRY_NAME
WHERE lower(a.Has_Online_delivery) = 'yes'
GROUP BY a.COUNTRY_NAME, g.n"""
sql("share_within_group", ONLINE)
sql("argmax_groups", W_CLEAN + ", " + LOCALITY_COUNTS + " SELECT City, Locality, REST_COUNT FROM winners")
QUIET = W_CLEAN + ", " + LOCALITY_COUNTS + """
SELECT City, Locality, REST_COUNT FROM sized WHERE from_bottom = 1"""
sql("argmin_groups", QUIET)
CUISINES = W_CLEAN + ", " + LOCALITY_COUNTS + """
, vf AS (SELECT Locality, unnest(string_split(Cuisines, '|')) AS Cuisines FROM winner_rows)
SELECT Cuisines, count(Cuisines) AS N FROM vf GROUP BY Locality, Cuisines"""
sql("top_group_item_counts", CUISINES)
sql("count_cast", W_CLEAN + " SELECT count(CAST(RestaurantID AS DECIMAL(18,0))) AS REST_COUNT FROM clean")

# -- windows / sort / set --------------------------------------------------------
sql("running_count_asc", W_CLEAN + f"""
SELECT City, Locality, count(Locality) AS COUNT_LOCALITY,
       CAST(sum(count(Locality)) OVER (PARTITION BY City ORDER BY City, Locality) AS BIGINT) AS ROLL_COUNT
FROM clean WHERE lower(COUNTRY_NAME) = '{HOME}' GROUP BY Locality, City""")
RUNNING = W_CLEAN + f"""
SELECT COUNTRY_NAME, City, Locality, count(Locality) AS TOTAL_REST,
       CAST(sum(count(Locality)) OVER (PARTITION BY COUNTRY_NAME, City ORDER BY Locality DESC) AS BIGINT)
         AS ROLL_COUNT
FROM clean WHERE lower(COUNTRY_NAME) = '{HOME}' GROUP BY COUNTRY_NAME, City, Locality"""
sql("running_count_desc", RUNNING)
sql("grand_total_window", W_CLEAN + """
SELECT DISTINCT COUNTRY_NAME, count(CAST(RestaurantID AS DECIMAL(18,0))) OVER () AS TOTAL_REST FROM clean""")
sql("sort_desc", W_CLEAN + " SELECT Currency, count(Currency) AS N FROM clean GROUP BY Currency ORDER BY 2 DESC")
PER_CITY = W_CLEAN + """
SELECT COUNTRY_NAME, City, count(City) AS TOTAL_REST FROM clean GROUP BY COUNTRY_NAME, City ORDER BY 1, 2, 3 DESC"""
sql("sort_mixed", PER_CITY)
sql("sort_by_name", QUIET + " ORDER BY City")
BOOKING = W_CLEAN + f"""
SELECT 'WITH_TABLE' AS TABLE_BOOKING_OPT, count(Has_Table_booking) AS TOTAL_REST,
       {ratio("sum(CAST(Rating * 10 AS BIGINT))", "count(Rating) * 10", 2)} AS AVG_RATING
FROM clean WHERE lower(Has_Table_booking) = 'yes' AND Locality = '{FOCUS}'
UNION
SELECT 'WITHOUT_TABLE', count(Has_Table_booking),
       {ratio("sum(CAST(Rating * 10 AS BIGINT))", "count(Rating) * 10", 2)}
FROM clean WHERE lower(Has_Table_booking) = 'no' AND Locality = '{FOCUS}'"""
sql("union_distinct", BOOKING)

# -- scalar functions ---------------------------------------------------------------
sql("fn_cast_int", W_CLEAN + """
SELECT RestaurantID, CAST(trunc(Average_Cost_for_two) AS INTEGER) AS COST_INT FROM clean""")
sql("fn_cast_decimal", W_CLEAN + """
SELECT RestaurantID, Rating, CAST(Rating AS DECIMAL(18,0)) AS RATING_WHOLE FROM clean""")
sql("fn_round", W_CLEAN + """
SELECT RestaurantID, CAST(round(Rating, 0) AS DECIMAL(3,0)) AS ROUND_RATING,
       CAST(round(CAST(Average_Cost_for_two AS DECIMAL(10,2)), 1) AS DECIMAL(10,1)) AS ROUND_COST
FROM clean""")
sql("fn_replace", W_RAW + ", " + QMARK + """
SELECT RestaurantID, City, replace(City, '?', 'i') AS CITY_FIXED FROM qm""")
sql("fn_split", W_CLEAN + " SELECT RestaurantID, unnest(string_split(Cuisines, '|')) AS CUISINE FROM clean")
sql("rating_band", W_CLEAN + " SELECT RestaurantID, Rating, RATE_CATEGORY FROM clean")
sql("fn_percentage", W_CLEAN + f"""
, g AS (SELECT City, count(CASE WHEN lower(Has_Table_booking) = 'yes' THEN RestaurantID END) AS WITH_BOOKING,
               count(RestaurantID) AS TOTAL_REST FROM clean GROUP BY City)
SELECT City, WITH_BOOKING, TOTAL_REST, {pct("WITH_BOOKING", "TOTAL_REST")} AS PCT FROM g""")

# -- listing questions ----------------------------------------------------------------
sql("clean_listings", W_CLEAN + " SELECT * FROM clean")
sql("misspelled_cities", W_RAW + ", " + QMARK + """
SELECT DISTINCT City, replace(City, '?', 'i') AS CORRECTED FROM qm WHERE City LIKE '%?%'""")
sql("misspelt_places", W_RAW + """,
named AS (SELECT CAST(RestaurantID AS BIGINT) % 40 AS kind, City || ' ' || split_part(Cuisines, '|', 1) AS p FROM raw),
placed AS (
  SELECT CASE kind WHEN 1 THEN p[1:2] || p[4:] WHEN 2 THEN p[1:3] || p[5] || p[4] || p[6:] WHEN 3 THEN p[1] || '?' || p[3:]
              WHEN 4 THEN p || 'x' ELSE p END AS s FROM named),
counted AS (SELECT s, count(*) AS n FROM placed WHERE length(s) >= 5 GROUP BY s),
near AS (
  SELECT a.s, a.n, b.s AS t, b.n AS m, levenshtein(a.s, b.s) AS e FROM counted a JOIN counted b
  ON a.s <> b.s AND b.n >= 3 * a.n AND levenshtein(a.s, b.s) <= 2),
best AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY m DESC, e, t) AS place FROM near)
SELECT s AS SPELLING, n AS N, t AS CORRECTED, m AS CORRECTED_N, CAST(e AS INTEGER) AS EDITS FROM best WHERE place = 1""")
sql("busiest_parts", """
SELECT l_partkey, count(*) AS N FROM lineitem GROUP BY l_partkey
QUALIFY count(*) = max(count(*)) OVER ()""")
sql("listings_per_city", PER_CITY)
sql("running_listings", RUNNING)
sql("running_listings_blocks", RUNNING)
sql("running_lines_blocks", """
SELECT l_returnflag, CAST(l_shipdate AS DATE) AS SHIPPED, l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS QUANTITY,
       CAST(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_returnflag ORDER BY CAST(l_shipdate AS DATE)) AS BIGINT)
         AS ROLL_QUANTITY
FROM lineitem""")
sql("country_share", SHARE)
sql("listings_per_country", W_CLEAN + """
SELECT COUNTRY_NAME, count(CAST(RestaurantID AS DECIMAL(18,0))) AS REST_COUNT FROM clean GROUP BY COUNTRY_NAME""")
sql("online_share", ONLINE)
sql("busiest_locality", W_CLEAN + ", " + LOCALITY_COUNTS + " SELECT Locality, REST_COUNT FROM winners")
sql("busiest_locality_sketch", SQL["busiest_locality"])
sql("busiest_locality_menus", W_CLEAN + ", " + LOCALITY_COUNTS + " SELECT Locality, Cuisines FROM winner_rows")
sql("busiest_locality_cuisines", CUISINES)
sql("quietest_localities", QUIET)
sql("busiest_locality_booking", W_CLEAN + ", " + LOCALITY_COUNTS + """
SELECT Locality, count(Has_Table_booking) AS TABLE_BOOKING_OPTION FROM winner_rows
WHERE lower(Has_Table_booking) = 'yes' GROUP BY Locality""")
sql("booking_vs_rating", BOOKING)
sql("location_ratings", LOCATION)
sql("best_moderate_cost", W_CLEAN + f" SELECT * FROM clean WHERE {BEST}")
sql("high_rated_by_price", HIGH_RATED)


# =====================================================================
# Order database views, stages, dimensions, fact
# =====================================================================
N_SUP = "(SELECT count(*) FROM supplier)"
OLTP = f"""cities AS (SELECT n_nationkey AS CityID, n_name AS CityName, n_nationkey AS StateProvinceID FROM nation),
provinces AS (
  SELECT n_nationkey AS StateProvinceID, 'N' || CAST(n_nationkey AS VARCHAR) AS StateProvinceCode,
         n_name || ' Province' AS StateProvinceName, n_regionkey AS CountryID FROM nation),
countries AS (SELECT r_regionkey AS CountryID, r_name AS CountryName, 'Formal ' || r_name AS FormalName FROM region),
customers AS (
  SELECT c_custkey AS CustomerID, c_name AS CustomerName, c_mktsegment AS CustomerCategoryID,
         c_nationkey AS DeliveryCityID, (c_nationkey + 7) % 25 AS PostalCityID FROM customer),
categories AS (SELECT DISTINCT c_mktsegment AS CustomerCategoryID, c_mktsegment AS CustomerCategoryName FROM customer),
stock_items AS (
  SELECT p_partkey AS StockItemID, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS StockItemName, p_brand AS Brand,
         CAST(p_size AS VARCHAR) AS Size, split_part(p_name, ' ', 1) AS ColorID FROM part),
colors AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS ColorID, split_part(p_name, ' ', 1) AS ColorName FROM part),
people AS (
  SELECT s_suppkey AS PersonID, s_name AS FullName, replace(s_name, 'Supplier#', 'S') AS PreferredName,
         lower(replace(s_name, '#', '.')) AS LogonName,
         '{{"nation": ' || CAST(s_nationkey AS VARCHAR) || '}}' AS CustomFields,
         '(' || CAST(s_nationkey AS VARCHAR) || ') 555-' || CAST(s_suppkey AS VARCHAR) AS PhoneNumber,
         '(' || CAST(s_nationkey AS VARCHAR) || ') 556-' || CAST(s_suppkey AS VARCHAR) AS FaxNumber,
         lower(replace(s_name, '#', '.')) || '@example.com' AS EmailAddress,
         CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END AS IsSalesperson
  FROM supplier),
orders_v AS (
  SELECT o_orderkey AS OrderID, CAST(o_orderdate AS DATE) AS OrderDate, o_custkey AS CustomerID,
         (o_custkey % 50) * 2 % {N_SUP} AS SalespersonPersonID,
         CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderkey % {N_SUP} END AS PickedByPersonID
  FROM orders),
lines AS (
  SELECT l_orderkey AS OrderID, l_linenumber AS LineNumber, l_partkey AS StockItemID,
         CAST(l_quantity AS INTEGER) AS Quantity, CAST(l_tax * 100 AS DECIMAL(18,3)) AS TaxRate,
         CASE WHEN CAST(l_quantity AS INTEGER) > 0 THEN
           CAST(CAST((2 * CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) + CAST(l_quantity AS INTEGER))
                     // (2 * CAST(l_quantity AS INTEGER)) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) END AS UnitPrice
  FROM lineitem),
city_details AS (
  SELECT ci.CityID, ci.CityName, sp.StateProvinceCode, sp.StateProvinceName, co.CountryName, co.FormalName
  FROM cities ci LEFT JOIN provinces sp ON ci.StateProvinceID = sp.StateProvinceID
  LEFT JOIN countries co ON sp.CountryID = co.CountryID),
customers_stage_id AS (
  SELECT cu.CustomerID, cu.CustomerName, cat.CustomerCategoryName,
         dc.CityName AS DeliveryCityName, dc.StateProvinceCode AS DeliveryStateProvinceCode,
         dc.StateProvinceName AS DeliveryStateProvinceName, dc.CountryName AS DeliveryCountryName,
         dc.FormalName AS DeliveryFormalName,
         pc.CityName AS PostalCityName, pc.StateProvinceCode AS PostalStateProvinceCode,
         pc.StateProvinceName AS PostalStateProvinceName, pc.CountryName AS PostalCountryName,
         pc.FormalName AS PostalFormalName
  FROM customers cu LEFT JOIN categories cat ON cu.CustomerCategoryID = cat.CustomerCategoryID
  LEFT JOIN city_details dc ON cu.DeliveryCityID = dc.CityID
  LEFT JOIN city_details pc ON cu.PostalCityID = pc.CityID),
customers_stage AS (SELECT * EXCLUDE (CustomerID) FROM customers_stage_id),
products_stage_id AS (
  SELECT s.StockItemID, s.StockItemName AS ProductName, c.ColorName AS ProductColour, s.Brand AS ProductBrand,
         s.Size AS ProductSize
  FROM stock_items s LEFT JOIN colors c ON s.ColorID = c.ColorID),
products_stage AS (SELECT * EXCLUDE (StockItemID) FROM products_stage_id),
salespeople_stage AS (
  SELECT FullName, PreferredName, LogonName, PhoneNumber, FaxNumber, EmailAddress FROM people WHERE IsSalesperson = 1),
picking_stage_id AS (
  SELECT PersonID, FullName, PreferredName, LogonName, CustomFields, PhoneNumber, FaxNumber, EmailAddress
  FROM people
  WHERE PersonID IN (SELECT PickedByPersonID FROM orders_v WHERE PickedByPersonID IS NOT NULL)
    AND LogonName IS NOT NULL),
picking_stage AS (SELECT * EXCLUDE (PersonID) FROM picking_stage_id),
wide AS (
  SELECT o.OrderID, l.LineNumber, o.OrderDate, cu.CustomerName, l.Quantity, l.UnitPrice, l.TaxRate,
         sp.LogonName, cd.CityName, cd.StateProvinceName, cd.CountryName, si.StockItemName,
         pk.LogonName AS PickingStaffName
  FROM orders_v o
  LEFT JOIN customers cu ON cu.CustomerID = o.CustomerID
  LEFT JOIN lines l ON o.OrderID = l.OrderID
  LEFT JOIN people sp ON o.SalespersonPersonID = sp.PersonID
  LEFT JOIN city_details cd ON cd.CityID = cu.DeliveryCityID
  LEFT JOIN stock_items si ON si.StockItemID = l.StockItemID
  LEFT JOIN people pk ON o.PickedByPersonID = pk.PersonID),
orders_stage AS (
  SELECT OrderDate, Quantity, UnitPrice, TaxRate, CustomerName, CityName, StateProvinceName, CountryName,
         StockItemName, LogonName, PickingStaffName FROM wide),
d0 AS (SELECT min(CAST(o_orderdate AS DATE)) AS d FROM orders)"""
W_OLTP = "WITH " + OLTP

# First load of every dimension on the first order date: keys numbered by business key.
DIMS = """,
dim_cities AS (
  SELECT row_number() OVER (ORDER BY CityName, StateProvName, CountryName) AS CityKey, CityName, StateProvName,
         CountryName, m.StateProvCode, m.CountryFormalName
  FROM (SELECT DeliveryCityName AS CityName, DeliveryStateProvinceName AS StateProvName,
               DeliveryCountryName AS CountryName,
               min({'StateProvCode': DeliveryStateProvinceCode, 'CountryFormalName': DeliveryFormalName}) AS m
        FROM customers_stage GROUP BY 1, 2, 3)),
dim_salespeople AS (SELECT row_number() OVER (ORDER BY LogonName) AS SalespersonKey, * FROM salespeople_stage),
dim_customers AS (
  SELECT row_number() OVER (ORDER BY CustomerName) AS CustomerKey, CustomerName, CustomerCategoryName,
         DeliveryCityName, DeliveryStateProvinceCode AS DeliveryStateProvCode, DeliveryCountryName,
         PostalCityName, PostalStateProvinceCode AS PostalStateProvCode, PostalCountryName,
         (SELECT d FROM d0) AS StartDate, CAST(NULL AS DATE) AS EndDate
  FROM customers_stage),
dim_products AS (
  SELECT row_number() OVER (ORDER BY ProductName) AS ProductKey, *, (SELECT d FROM d0) AS StartDate,
         CAST(NULL AS DATE) AS EndDate FROM products_stage),
dim_picking AS (
  SELECT row_number() OVER (ORDER BY LogonName) AS PickingStaffKey, *, (SELECT d FROM d0) AS StartDate,
         CAST(NULL AS DATE) AS EndDate FROM picking_stage)"""


def same(a: str, b: str) -> str:
    """Business keys are equal without regard to case and trailing blanks."""
    return f"lower(rtrim({a})) = lower(rtrim({b}))"


def valid(alias: str, on: str) -> str:
    return f"{alias}.StartDate <= {on} AND {on} <= coalesce({alias}.EndDate, DATE '9999-12-31')"


def fact_sql(strict: bool = False) -> str:
    j = "JOIN" if strict else "LEFT JOIN"
    k = (lambda c: c) if strict else (lambda c: f"coalesce({c}, -1)")
    return f""",
fact AS (
  SELECT CAST({k('cu.CustomerKey')} AS BIGINT) AS CustomerKey, CAST({k('ci.CityKey')} AS BIGINT) AS CityKey,
         CAST({k('pr.ProductKey')} AS BIGINT) AS ProductKey,
         CAST({k('sp.SalespersonKey')} AS BIGINT) AS SalespersonKey,
         CAST(year(s.OrderDate) * 10000 + month(s.OrderDate) * 100 + day(s.OrderDate) AS INTEGER) AS DateKey,
         CAST({k('pk.PickingStaffKey')} AS BIGINT) AS PickingStaffKey,
         s.Quantity, s.UnitPrice, s.TaxRate,
         CAST(s.Quantity * s.UnitPrice AS DECIMAL(18,2)) AS TotalBeforeTax,
         CAST(s.Quantity * s.UnitPrice * (1 + s.TaxRate * 0.01) AS DECIMAL(18,2)) AS TotalAfterTax
  FROM (SELECT * FROM orders_stage WHERE Quantity IS NOT NULL) s
  {j} dim_customers cu ON s.CustomerName = cu.CustomerName AND {valid('cu', 's.OrderDate')}
  {j} dim_cities ci ON s.CityName = ci.CityName AND s.StateProvinceName = ci.StateProvName
                      AND s.CountryName = ci.CountryName
  {j} dim_products pr ON s.StockItemName = pr.ProductName AND {valid('pr', 's.OrderDate')}
  {j} dim_salespeople sp ON s.LogonName = sp.LogonName
  {j} dim_picking pk ON s.PickingStaffName = pk.LogonName AND {valid('pk', 's.OrderDate')})"""


W_FACT = W_OLTP + DIMS + fact_sql()

sql("scan_source_join", W_OLTP + " SELECT * FROM orders_v")
sql("conform_schema", W_OLTP + " SELECT * FROM orders_stage")
sql("extract_date_slice", W_OLTP + " SELECT * FROM orders_stage WHERE OrderDate = (SELECT d FROM d0)")
sql("join_left", W_OLTP + """
SELECT o.OrderID, p.LogonName AS PickerLogon FROM orders_v o LEFT JOIN people p ON p.PersonID = o.PickedByPersonID""")
sql("join_snowflake", W_OLTP + " SELECT * FROM city_details")
sql("join_role_playing", W_OLTP + """
SELECT CustomerName, DeliveryCityName, DeliveryCountryName, PostalCityName, PostalCountryName FROM customers_stage""")
sql("join_order_lines_wide", W_OLTP + " SELECT * FROM wide")
sql("extract_customers", W_OLTP + " SELECT * FROM customers_stage")
sql("rowcount_guard", W_OLTP + " SELECT * FROM customers_stage")
sql("extract_products", W_OLTP + " SELECT * FROM products_stage")
sql("extract_salespeople", W_OLTP + " SELECT * FROM salespeople_stage")
sql("extract_picking_staff", W_OLTP + " SELECT * FROM picking_stage")
sql("extract_orders", W_OLTP + " SELECT * FROM orders_stage")

# -- type 1 -----------------------------------------------------------------
CITIES_BEFORE = """,
cities_before AS (
  SELECT CAST(CityID + 1 AS BIGINT) AS CityKey,
         CASE WHEN CityID % 4 = 0 THEN lower(CityName) || ' ' ELSE CityName END AS CityName,
         StateProvinceName AS StateProvName, CountryName,
         StateProvinceCode AS StateProvCode, FormalName AS CountryFormalName
  FROM city_details WHERE CityID % 2 = 0),
delivery AS (
  SELECT CustomerName, DeliveryCityName AS CityName, DeliveryStateProvinceName AS StateProvName,
         DeliveryCountryName AS CountryName, DeliveryStateProvinceCode AS StateProvCode,
         DeliveryFormalName AS CountryFormalName
  FROM customers_stage)"""
sql("join_composite", W_OLTP + CITIES_BEFORE + """
SELECT d.CustomerName, c.CityKey FROM delivery d JOIN cities_before c
  ON lower(rtrim(d.CityName)) = lower(rtrim(c.CityName)) AND d.StateProvName = c.StateProvName AND d.CountryName = c.CountryName""")
sql("anti_join_composite", W_OLTP + CITIES_BEFORE + """
SELECT d.CustomerName, d.CityName, d.StateProvName, d.CountryName FROM delivery d
WHERE NOT EXISTS (SELECT 1 FROM cities_before c WHERE lower(rtrim(d.CityName)) = lower(rtrim(c.CityName)) AND d.StateProvName = c.StateProvName
                  AND d.CountryName = c.CountryName)""")
W_CITIES = W_OLTP + CITIES_BEFORE + """,
staged AS (
  SELECT CityName, StateProvName, CountryName,
         min({'StateProvCode': StateProvCode, 'CountryFormalName': CountryFormalName}) AS m
  FROM delivery GROUP BY 1, 2, 3),
after AS (
SELECT c.CityKey, s.CityName, s.StateProvName, s.CountryName, s.m.StateProvCode, s.m.CountryFormalName
FROM staged s JOIN cities_before c
  ON lower(rtrim(s.CityName)) = lower(rtrim(c.CityName)) AND s.StateProvName = c.StateProvName AND s.CountryName = c.CountryName
UNION ALL
SELECT (SELECT coalesce(max(CityKey), 0) FROM cities_before)
         + row_number() OVER (ORDER BY s.CityName, s.StateProvName, s.CountryName),
       s.CityName, s.StateProvName, s.CountryName, s.m.StateProvCode, s.m.CountryFormalName
FROM staged s
WHERE NOT EXISTS (SELECT 1 FROM cities_before c WHERE lower(rtrim(s.CityName)) = lower(rtrim(c.CityName)) AND s.StateProvName = c.StateProvName
                  AND s.CountryName = c.CountryName))"""
sql("scd1_cities", W_CITIES + " SELECT * FROM after")
sql("load_cities", W_CITIES + """
SELECT * FROM cities_before WHERE CityKey NOT IN (SELECT CityKey FROM after) UNION ALL SELECT * FROM after""")
W_SALES = W_OLTP + """,
before AS (
  SELECT CAST(PersonID + 1 AS BIGINT) AS SalespersonKey,
         CASE WHEN PersonID % 8 = 0 THEN upper(LogonName) ELSE LogonName END AS LogonName,
         'OLD ' || FullName AS FullName, PreferredName, PhoneNumber, FaxNumber, EmailAddress
  FROM people
  WHERE IsSalesperson = 1 AND PersonID % 4 = 0),
after AS (
SELECT b.SalespersonKey, s.LogonName, s.FullName, s.PreferredName, s.PhoneNumber, s.FaxNumber, s.EmailAddress
FROM salespeople_stage s JOIN before b ON lower(rtrim(s.LogonName)) = lower(rtrim(b.LogonName))
UNION ALL
SELECT (SELECT coalesce(max(SalespersonKey), 0) FROM before) + row_number() OVER (ORDER BY s.LogonName),
       s.LogonName, s.FullName, s.PreferredName, s.PhoneNumber, s.FaxNumber, s.EmailAddress
FROM salespeople_stage s WHERE NOT EXISTS (SELECT 1 FROM before b
                                          WHERE lower(rtrim(b.LogonName)) = lower(rtrim(s.LogonName))))"""

sql("scd1_salespeople", W_SALES + " SELECT * FROM after")
sql("load_salespeople", W_SALES + """
SELECT * FROM before WHERE SalespersonKey NOT IN (SELECT SalespersonKey FROM after) UNION ALL SELECT * FROM after""")
sql("surrogate_keys", """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
                                   l_extendedprice, l_returnflag, l_linestatus, l_tax, l_discount) AS LineKey,
       l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem""")


# -- type 2 -----------------------------------------------------------------
def scd2_ctes(stage_id: str, id_col: str, bk: str, tracked: list[str], key: str,
              rename: dict[str, str] | None = None) -> str:
    """CTEs dim_before / stage / result for a type-2 run starting the day after d0.

    Inputs by id % 10: 9 new, 8 missing, 7 first tracked column changed, 6 unchanged
    plus an older version, 5 closed only and back in the stage, 4 first tracked column
    null in the dimension, 3 unchanged but spelled in capitals with a trailing blank
    in the stage.
    """
    rename = rename or {}
    src_cols = ", ".join(f"{s} AS {d}" for s, d in rename.items()) or ", ".join([bk, *tracked])
    first = tracked[0]
    t_cur = ", ".join(f"CASE WHEN _id % 10 = 7 THEN 'OLD ' || {c} WHEN _id % 10 = 4 THEN NULL ELSE {c} END AS {c}"
                      if c == first else c for c in tracked)
    t_old = ", ".join(f"'PREV ' || {c} AS {c}" if c == first else c for c in tracked)
    cols = ", ".join([bk, *tracked])
    diff = " OR ".join(f"lower(rtrim(s.{c})) IS DISTINCT FROM lower(rtrim(o.{c}))" for c in tracked)
    match = same(f"s.{bk}", f"o.{bk}")
    s_cols = ", ".join(f"s.{c}" for c in [bk, *tracked])
    o_cols = ", ".join(f"o.{c}" for c in [key, bk, *tracked])
    return f""",
st AS (SELECT {id_col} AS _id, {src_cols} FROM {stage_id}),
mx AS (SELECT max(_id) AS m FROM st),
dim_before AS (
  SELECT CAST(_id + 1 AS BIGINT) AS {key}, {bk}, {t_cur}, (SELECT d FROM d0) AS StartDate,
         CAST(NULL AS DATE) AS EndDate
  FROM st WHERE _id % 10 NOT IN (9, 5)
  UNION ALL
  SELECT CAST(_id + 2 + (SELECT m FROM mx) AS BIGINT), {bk}, {t_old}, (SELECT d FROM d0) - 365,
         (SELECT d FROM d0) - 1
  FROM st WHERE _id % 10 IN (5, 6)),
stage AS (
  SELECT CASE WHEN _id % 10 = 3 THEN upper({bk}) || ' ' ELSE {bk} END AS {bk}, {", ".join(tracked)}
  FROM st WHERE _id % 10 <> 8),
open_rows AS (SELECT * FROM dim_before WHERE EndDate IS NULL),
changed_keys AS (SELECT s.{bk} FROM stage s JOIN open_rows o ON {match} WHERE {diff}),
versions AS (
  SELECT s.*, CASE WHEN s.{bk} IN (SELECT {bk} FROM changed_keys) THEN 'changed' ELSE 'new' END AS kind
  FROM stage s
  WHERE s.{bk} IN (SELECT {bk} FROM changed_keys)
     OR NOT EXISTS (SELECT 1 FROM open_rows o WHERE {match})),
numbered AS (
  SELECT (SELECT max({key}) FROM dim_before) + row_number() OVER (ORDER BY {bk}) AS {key}, {cols},
         (SELECT d FROM d0) + 1 AS StartDate, CAST(NULL AS DATE) AS EndDate, kind
  FROM versions),
b_changed AS (SELECT * EXCLUDE (kind) FROM numbered WHERE kind = 'changed'),
b_new AS (SELECT * EXCLUDE (kind) FROM numbered WHERE kind = 'new'),
b_closed AS (
  SELECT {o_cols}, o.StartDate,
         CASE WHEN o.{bk} IN (SELECT {bk} FROM changed_keys) THEN (SELECT d FROM d0) END AS EndDate
  FROM open_rows o WHERE EXISTS (SELECT 1 FROM stage s WHERE {match})),
b_expired AS (
  SELECT {o_cols}, o.StartDate, (SELECT d FROM d0) AS EndDate
  FROM open_rows o WHERE NOT EXISTS (SELECT 1 FROM stage s WHERE {match})),
b_history AS (SELECT * FROM dim_before WHERE EndDate IS NOT NULL),
result AS (
  SELECT * FROM b_changed UNION ALL SELECT * FROM b_closed UNION ALL SELECT * FROM b_new
  UNION ALL SELECT * FROM b_expired UNION ALL SELECT * FROM b_history)"""


CUST_TRACKED = ["CustomerCategoryName", "DeliveryCityName", "DeliveryStateProvCode", "DeliveryCountryName",
                "PostalCityName", "PostalStateProvCode", "PostalCountryName"]
CUST_RENAME = {"CustomerName": "CustomerName", "CustomerCategoryName": "CustomerCategoryName",
               "DeliveryCityName": "DeliveryCityName", "DeliveryStateProvinceCode": "DeliveryStateProvCode",
               "DeliveryCountryName": "DeliveryCountryName", "PostalCityName": "PostalCityName",
               "PostalStateProvinceCode": "PostalStateProvCode", "PostalCountryName": "PostalCountryName"}
W_CUST = W_OLTP + scd2_ctes("customers_stage_id", "CustomerID", "CustomerName", CUST_TRACKED, "CustomerKey",
                            CUST_RENAME)
W_PROD = W_OLTP + scd2_ctes("products_stage_id", "StockItemID", "ProductName",
                            ["ProductColour", "ProductBrand", "ProductSize"], "ProductKey")
W_PICK = W_OLTP + scd2_ctes("picking_stage_id", "PersonID", "LogonName",
                            ["FullName", "PreferredName", "CustomFields", "PhoneNumber", "FaxNumber", "EmailAddress"],
                            "PickingStaffKey")

sql("scd2_changed", W_CUST + " SELECT * FROM b_changed")
sql("scd2_closed_and_carried", W_CUST + " SELECT * FROM b_closed")
sql("scd2_new", W_CUST + " SELECT * FROM b_new")
sql("scd2_expired", W_CUST + " SELECT * FROM b_expired")
sql("union_all_branches", W_CUST + " SELECT * FROM result")
sql("scd2_customers", W_CUST + " SELECT * FROM result")
sql("upsert_by_key", W_CUST + """
SELECT * FROM dim_before WHERE CustomerKey NOT IN (SELECT CustomerKey FROM result)
UNION ALL SELECT * FROM result""")
sql("load_dimension", W_CUST + " SELECT * FROM result")
sql("load_products", W_PROD + " SELECT * FROM result")
sql("load_picking_staff", W_PICK + " SELECT * FROM result")
sql("scd2_same_date_correction", W_CUST + """
, opened AS (SELECT *, StartDate = (SELECT d FROM d0) + 1 AS today, right(rtrim(CustomerName), 1) AS digit FROM result)
SELECT * EXCLUDE (today, digit) REPLACE (
  CASE WHEN today AND digit IN ('7', '9') THEN 'FIX ' || CustomerCategoryName ELSE CustomerCategoryName END
    AS CustomerCategoryName)
FROM opened WHERE NOT (today AND digit = '5')""")
sql("replaced_rows", W_CUST + " SELECT * FROM dim_before WHERE CustomerKey IN (SELECT CustomerKey FROM result)")
sql("scd2_products", W_PROD + " SELECT * FROM result")
sql("scd2_picking_staff", W_PICK + " SELECT * FROM result")
sql("filter_open_rows", W_CUST + " SELECT * FROM dim_before WHERE EndDate IS NULL")
CHANGED = " OR ".join(f"s.{c} IS DISTINCT FROM o.{c}" for c in CUST_TRACKED)
sql("changed_rows", W_CUST + f"""
SELECT s.* FROM stage s JOIN open_rows o ON {same("s.CustomerName", "o.CustomerName")} WHERE {CHANGED}""")
sql("join_residual", W_CUST + f"""
SELECT s.CustomerName, o.CustomerKey, s.CustomerCategoryName AS NEW_CATEGORY, o.CustomerCategoryName AS OLD_CATEGORY
FROM stage s JOIN open_rows o ON {same("s.CustomerName", "o.CustomerName")} WHERE {CHANGED}""")
sql("join_left_on_predicate", W_CUST + """
SELECT cu.CustomerKey, cu.CustomerName, cu.StartDate, pl.CustomerName AS PL_NAME
FROM dim_before cu LEFT JOIN changed_keys pl ON pl.CustomerName = cu.CustomerName AND cu.EndDate IS NULL""")
sql("fn_case_null", W_CUST + """
SELECT cu.CustomerKey, CASE WHEN pl.CustomerName IS NULL THEN NULL ELSE (SELECT d FROM d0) END AS NEW_END_DATE
FROM dim_before cu LEFT JOIN changed_keys pl ON pl.CustomerName = cu.CustomerName AND cu.EndDate IS NULL""")
sql("anti_join", W_CUST + f"""
SELECT s.CustomerName FROM stage s
WHERE NOT EXISTS (SELECT 1 FROM dim_before d WHERE {same("d.CustomerName", "s.CustomerName")})""")
ASOF = W_CUST + f"""
SELECT o.OrderID, o.OrderDate, r.CustomerKey
FROM orders_v o LEFT JOIN customers c ON c.CustomerID = o.CustomerID
LEFT JOIN result r ON {same("r.CustomerName", "c.CustomerName")} AND {valid('r', 'o.OrderDate')}"""
sql("join_asof_dimension", ASOF)
sql("join_asof_carry", ASOF)
sql("scd2_change_log", W_OLTP + """,
told AS (
  SELECT c.CustomerName, o.OrderDate AS day,
         min({'gone': o.OrderID % 7 = 0, 'Category': 'C' || CAST(o.OrderID % 3 AS VARCHAR),
              'Tier': 'T' || CAST(o.OrderID // 8 % 2 AS VARCHAR)}) AS m
  FROM orders_v o JOIN customers c ON c.CustomerID = o.CustomerID GROUP BY 1, 2),
before AS (
  SELECT CAST(CustomerID AS BIGINT) AS CustomerKey, CustomerName, 'C0' AS Category, 'T0' AS Tier,
         (SELECT d FROM d0) - 10 AS StartDate, CAST(NULL AS DATE) AS EndDate FROM customers WHERE CustomerID % 3 <> 0
  UNION ALL
  SELECT CustomerID + 1000000000, CustomerName, 'C1', 'T0', (SELECT d FROM d0) - 20, (SELECT d FROM d0) - 11
  FROM customers WHERE CustomerID % 5 = 1),
states AS (
  SELECT CustomerName, StartDate AS day, CustomerKey AS old, Category || '/' || Tier AS state FROM before
  WHERE EndDate IS NULL
  UNION ALL
  SELECT CustomerName, day, NULL, CASE WHEN m.gone THEN NULL ELSE m.Category || '/' || m.Tier END FROM told),
turns AS (
  SELECT *, row_number() OVER w AS n, lag(state) OVER w AS was FROM states
  WINDOW w AS (PARTITION BY CustomerName ORDER BY day)),
spans AS (
  SELECT *, lead(day) OVER (PARTITION BY CustomerName ORDER BY day) - 1 AS EndDate
  FROM turns WHERE state IS DISTINCT FROM was),
versions AS (SELECT * FROM spans WHERE state IS NOT NULL)
SELECT coalesce(old, (SELECT max(CustomerKey) FROM before)
                     + row_number() OVER (PARTITION BY old IS NULL ORDER BY day, CustomerName)) AS CustomerKey,
       CustomerName, split_part(state, '/', 1) AS Category, split_part(state, '/', 2) AS Tier,
       day AS StartDate, EndDate FROM versions
UNION ALL SELECT * FROM before WHERE EndDate IS NOT NULL""")
SEEN_COLS = ", ".join(CUST_TRACKED)
sql("scd2_late_day", W_CUST + f""",
middle AS (
  SELECT * REPLACE (CASE WHEN right(rtrim(CustomerName), 1) = '4' THEN 'MID ' || CustomerCategoryName
                         ELSE CustomerCategoryName END AS CustomerCategoryName)
  FROM stage WHERE right(rtrim(CustomerName), 1) <> '3'),
seen AS (
  SELECT 1 AS turn, CustomerName, {SEEN_COLS} FROM open_rows
  UNION ALL SELECT 2, CustomerName, {SEEN_COLS} FROM middle
  UNION ALL SELECT 3, CustomerName, {SEEN_COLS} FROM stage),
marked AS (
  SELECT *, lower(rtrim(CustomerName)) AS k, concat_ws('/', {", ".join(f"coalesce({c}, '~')" for c in CUST_TRACKED)}) AS state
  FROM seen),
begun AS (
  SELECT *, CASE WHEN lag(turn) OVER w = turn - 1 AND lag(state) OVER w = state THEN 0 ELSE 1 END AS begins
  FROM marked WINDOW w AS (PARTITION BY k ORDER BY turn)),
islands AS (SELECT *, sum(begins) OVER (PARTITION BY k ORDER BY turn) AS island FROM begun),
days AS (SELECT [d, d + 5, d + 10] AS first, [d + 4, d + 9, NULL] AS last FROM d0),
merged AS (
  SELECT arg_min(CustomerName, turn) AS CustomerName,
         {", ".join(f"arg_min(coalesce({c}, '~'), turn) AS {c}" for c in CUST_TRACKED)},
         any_value(first)[min(turn)] AS StartDate, any_value(last)[max(turn)] AS EndDate
  FROM islands, days GROUP BY k, island)
SELECT upper(rtrim(CustomerName)) AS CustomerName, {", ".join(f"nullif({c}, '~') AS {c}" for c in CUST_TRACKED)},
       StartDate, EndDate FROM merged
UNION ALL SELECT upper(rtrim(CustomerName)), {SEEN_COLS}, StartDate, EndDate FROM b_history""")

# -- calendar and measures ------------------------------------------------------
DATES = W_OLTP + ", od AS (SELECT DISTINCT OrderDate FROM orders_v)"
sql("fn_date_parts", DATES + """
SELECT OrderDate, CAST(year(OrderDate) AS INTEGER) AS YEAR, CAST(month(OrderDate) AS INTEGER) AS MONTH,
       CAST(day(OrderDate) AS INTEGER) AS DAY FROM od""")
sql("fn_quarter", DATES + " SELECT OrderDate, CAST(quarter(OrderDate) AS INTEGER) AS QUARTER FROM od")
sql("fn_month_start", DATES + " SELECT OrderDate, CAST(date_trunc('month', OrderDate) AS DATE) AS MONTH_START FROM od")
sql("fn_month_end", DATES + " SELECT OrderDate, last_day(OrderDate) AS MONTH_END FROM od")
sql("fn_date_names", DATES + """
SELECT OrderDate, strftime(OrderDate, '%B') AS MONTH_NAME, strftime(OrderDate, '%A') AS DAY_NAME FROM od""")
sql("fn_date_key", DATES + """
SELECT OrderDate, CAST(year(OrderDate) * 10000 + month(OrderDate) * 100 + day(OrderDate) AS INTEGER) AS DATE_KEY
FROM od""")
sql("fn_to_date", W_OLTP + """
SELECT OrderID, strftime(OrderDate, '%Y-%m-%d') AS ORDER_DATE_TEXT, CAST(strftime(OrderDate, '%Y-%m-%d') AS DATE)
       AS ORDER_DATE FROM orders_v""")
sql("fn_total_before_tax", W_OLTP + """
SELECT OrderID, LineNumber, Quantity, UnitPrice, CAST(Quantity * UnitPrice AS DECIMAL(18,2)) AS TOTAL_BEFORE_TAX
FROM lines""")
sql("fn_total_after_tax", W_OLTP + """
SELECT OrderID, LineNumber, Quantity, UnitPrice, TaxRate,
       CAST(Quantity * UnitPrice * (1 + TaxRate * 0.01) AS DECIMAL(18,2)) AS TOTAL_AFTER_TAX
FROM lines""")
CALENDAR = """,
cal AS (
  SELECT CAST(unnest(generate_series(min(OrderDate), max(OrderDate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders_v),
dim_date AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS DateKey, d AS DateValue,
         CAST(year(d) AS SMALLINT) AS Year, CAST(month(d) AS SMALLINT) AS Month, CAST(day(d) AS SMALLINT) AS Day,
         CAST(quarter(d) AS SMALLINT) AS Quarter, CAST(date_trunc('month', d) AS DATE) AS StartOfMonth,
         last_day(d) AS EndOfMonth, strftime(d, '%B') AS MonthName, strftime(d, '%A') AS DayOfWeekName
  FROM cal)"""
sql("dim_date", W_OLTP + CALENDAR + " SELECT * FROM dim_date")

# -- fact, loads, quality, summary -------------------------------------------------
sql("fact_orders", W_FACT + " SELECT * FROM fact")
sql("append_fact", W_FACT + " SELECT * FROM fact")
sql("load_fact", W_FACT + " SELECT * FROM fact")
sql("daily_run", W_FACT + " SELECT * FROM fact")
sql("star_lookup", W_OLTP + DIMS + fact_sql(strict=True) + " SELECT * FROM fact")
sql("dq_duplicate_keys", W_OLTP + """
SELECT OrderID, LineNumber, count(*) AS N FROM lines GROUP BY OrderID, LineNumber HAVING count(*) > 1""")
sql("dq_orphan_keys", W_FACT + CALENDAR + """
SELECT 'CustomerKey' AS KEY_NAME, CustomerKey AS KEY_VALUE, count(*) AS N FROM fact
WHERE CustomerKey NOT IN (SELECT CustomerKey FROM dim_customers) GROUP BY CustomerKey
UNION ALL SELECT 'CityKey', CityKey, count(*) FROM fact
WHERE CityKey NOT IN (SELECT CityKey FROM dim_cities) GROUP BY CityKey
UNION ALL SELECT 'ProductKey', ProductKey, count(*) FROM fact
WHERE ProductKey NOT IN (SELECT ProductKey FROM dim_products) GROUP BY ProductKey
UNION ALL SELECT 'SalespersonKey', SalespersonKey, count(*) FROM fact
WHERE SalespersonKey NOT IN (SELECT SalespersonKey FROM dim_salespeople) GROUP BY SalespersonKey
UNION ALL SELECT 'DateKey', DateKey, count(*) FROM fact
WHERE DateKey NOT IN (SELECT DateKey FROM dim_date) GROUP BY DateKey
UNION ALL SELECT 'PickingStaffKey', PickingStaffKey, count(*) FROM fact
WHERE PickingStaffKey NOT IN (SELECT PickingStaffKey FROM dim_picking) GROUP BY PickingStaffKey""")
def null_rows(table: str, source: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS TABLE_NAME, '{c}' AS COLUMN_NAME, count(*) FILTER (WHERE {c} IS NULL) AS NULL_COUNT "
        f"FROM {source}" for c in columns.split())


sql("dq_null_counts", W_FACT + CALENDAR + " " + " UNION ALL ".join([
    null_rows("orders_stage", "orders_stage", "OrderDate Quantity UnitPrice TaxRate CustomerName CityName "
              "StateProvinceName CountryName StockItemName LogonName PickingStaffName"),
    null_rows("dim_cities", "dim_cities", "CityKey"),
    null_rows("dim_salespeople", "dim_salespeople", "SalespersonKey"),
    null_rows("dim_customers", "dim_customers", "CustomerKey StartDate"),
    null_rows("dim_products", "dim_products", "ProductKey StartDate"),
    null_rows("dim_picking_staff", "dim_picking", "PickingStaffKey StartDate"),
    null_rows("dim_date", "dim_date", "DateKey DateValue Year Month Day Quarter StartOfMonth EndOfMonth MonthName "
              "DayOfWeekName"),
    null_rows("fact_orders", "fact", "CustomerKey CityKey ProductKey SalespersonKey DateKey PickingStaffKey"),
]))
sql("daily_run_changing_source", W_OLTP + """,
bounds AS (SELECT min(OrderDate) AS lo, max(OrderDate) AS hi, (max(OrderDate) - min(OrderDate)) // 3 AS third
           FROM orders_v),
served AS (SELECT DISTINCT DeliveryCityID AS CityID FROM customers WHERE CustomerID % 7 <> 3),
sold AS (
  SELECT o.*, l.*, CASE WHEN o.OrderDate < lo + CAST(third AS INTEGER) THEN 0
                        WHEN o.OrderDate < lo + CAST(2 * third AS INTEGER) THEN 1 ELSE 2 END AS period
  FROM orders_v o JOIN lines l ON l.OrderID = o.OrderID, bounds),
known AS (
  SELECT s.*, c.DeliveryCityID, c.CustomerCategoryID || CASE WHEN s.CustomerID % 5 = 1 AND period >= 1 THEN ' v1'
                                           WHEN s.CustomerID % 5 = 2 AND period >= 2 THEN ' v2' ELSE '' END AS category,
         i.Brand || CASE WHEN s.StockItemID % 4 = 1 AND period >= 1 THEN ' v1' ELSE '' END AS brand
  FROM sold s
  LEFT JOIN customers c ON c.CustomerID = s.CustomerID AND NOT (period = 2 AND c.CustomerID % 7 = 3)
  LEFT JOIN stock_items i ON i.StockItemID = s.StockItemID)
SELECT CAST(year(OrderDate) AS INTEGER) AS YEAR, category AS CustomerCategoryName, brand AS ProductBrand,
       cd.FormalName || CASE WHEN sv.CityID IS NOT NULL THEN ' r2' ELSE '' END AS CountryFormalName,
       count(*) AS ORDER_LINES,
       CAST(sum(CAST(Quantity * UnitPrice * (1 + TaxRate * 0.01) AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS REVENUE
FROM known k LEFT JOIN city_details cd ON cd.CityID = k.DeliveryCityID LEFT JOIN served sv ON sv.CityID = cd.CityID
GROUP BY ALL""")
sql("changed_members", W_OLTP + """,
told AS (
  SELECT CustomerID, CASE WHEN CustomerID % 5 = 0 THEN upper(CustomerName) || ' ' ELSE CustomerName END AS CustomerName
  FROM customers)
SELECT CustomerName, CASE WHEN CustomerID % 7 = 3 THEN 'gone' ELSE 'changed' END AS CHANGE FROM told
WHERE CustomerID % 7 = 3 OR CustomerID % 5 = 2""")
sql("periods_out_of_order", SQL["daily_run_changing_source"])
sql("mart_summary", W_FACT + CALENDAR + """
SELECT dd.Year, cu.CustomerCategoryName, count(*) AS ORDER_LINES, CAST(sum(f.Quantity) AS BIGINT) AS QUANTITY,
       CAST(sum(f.TotalAfterTax) AS DECIMAL(18,2)) AS REVENUE
FROM fact f LEFT JOIN dim_date dd ON f.DateKey = dd.DateKey
LEFT JOIN dim_customers cu ON f.CustomerKey = cu.CustomerKey
GROUP BY dd.Year, cu.CustomerCategoryName""")
sql("kept_summary", SQL["mart_summary"])
sql("late_members", W_OLTP + """
SELECT CAST(year(OrderDate) AS INTEGER) AS YEAR, c.CustomerCategoryID AS CustomerCategoryName, i.Brand AS ProductBrand,
       cd.FormalName AS CountryFormalName, count(*) AS ORDER_LINES,
       CAST(sum(CAST(Quantity * UnitPrice * (1 + TaxRate * 0.01) AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS REVENUE
FROM orders_v o JOIN lines l ON l.OrderID = o.OrderID
LEFT JOIN customers c ON c.CustomerID = o.CustomerID LEFT JOIN stock_items i ON i.StockItemID = l.StockItemID
LEFT JOIN city_details cd ON cd.CityID = c.DeliveryCityID
GROUP BY ALL""")
sql("extract_orders_landed", SQL["extract_orders"])
sql("extract_slice_landed", SQL["extract_date_slice"])
