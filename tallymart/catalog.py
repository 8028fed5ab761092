"""The registered queries on the driver's tables: every operator in use, and the same result as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymart.functions import derive, parsing
from tallymart.operators import history as H, identity as I, marts as M, publish as P, quality as Q, replay as R, star as S
from tallymart.plans import driver as D
from tallymart.sources import files, history_store, publication, sinks
from tallymart.tables import new_path, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The roles of the driver profile as SQL.
BASE = """
WITH o0 AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE WHEN o_orderkey % 50 = 7 THEN 'canceled' WHEN o_orderkey % 50 = 9 THEN 'unavailable' ELSE lower(o_orderstatus) END AS raw_status,
         o_orderdate AS bought, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + INTERVAL 1 DAY END AS approved,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(CAST(1 + o_orderkey % 5 AS INT)) END AS shipped,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(3 + o_orderkey % 80 AS INT)) END AS delivered,
         o_orderdate + INTERVAL 60 DAY AS due
  FROM orders),
o AS (
  SELECT *, CASE WHEN raw_status = 'canceled' THEN 'CANCELLED' WHEN raw_status = 'unavailable' THEN 'UNAVAILABLE' WHEN delivered IS NOT NULL THEN 'DELIVERED'
                 WHEN shipped IS NOT NULL THEN 'SHIPPED' WHEN approved IS NOT NULL THEN 'APPROVED' ELSE 'CREATED' END AS order_status,
         date_diff('day', approved, shipped) AS ship_days, date_diff('day', shipped, delivered) AS way_days, date_diff('day', bought, delivered) AS total_days,
         delivered > due AS is_delayed, CASE WHEN delivered > due THEN date_diff('day', due, delivered) ELSE 0 END AS delay_days
  FROM o0),
i AS (
  SELECT l_orderkey AS order_id, l_linenumber AS item, l_partkey AS product_id, l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS freight
  FROM lineitem),
c AS (SELECT c_custkey AS customer_id, c_name AS uname, c_nationkey AS zip, c_mktsegment AS city, n_name AS state FROM customer JOIN nation ON c_nationkey = n_nationkey),
s AS (SELECT s_suppkey AS seller_id, s_nationkey AS zip, s_name AS city, n_name AS state FROM supplier JOIN nation ON s_nationkey = n_nationkey),
p0 AS (
  SELECT p_partkey AS product_id, p_type AS category, CASE p_type WHEN 'ECONOMY' THEN 'economy goods' WHEN 'STANDARD' THEN 'standard goods' WHEN 'PROMO' THEN 'promotions'
         WHEN 'LARGE' THEN 'large goods' ELSE 'uncategorized' END AS category_en,
         CASE WHEN p_size % 10 <> 0 THEN p_size END AS length, CASE WHEN p_size % 10 <> 0 THEN p_size % 20 END AS height, CASE WHEN p_size % 10 <> 0 THEN p_size % 30 END AS width
  FROM part),
p AS (SELECT *, length * height * width AS volume, CASE WHEN length * height * width IS NULL THEN 'Unknown' WHEN length * height * width < 1000 THEN 'Small'
             WHEN length * height * width < 8000 THEN 'Medium' ELSE 'Large' END AS size_category FROM p0),
pay AS (SELECT CAST(floor(event_id / 2) AS BIGINT) AS order_id, 2 - event_id % 2 AS seq, event_type AS type FROM events),
pay1 AS (SELECT order_id, type FROM pay QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq, type) = 1),
f AS (
  SELECT i.order_id AS "OrderID", i.item AS "OrderItemID", o.customer_id AS "CustomerID", i.product_id AS "ProductID", i.seller_id AS "SellerID",
         CAST(strftime(bought, '%Y%m%d') AS INT) AS "DateKey", order_status AS "StatusID", c.zip AS "ZipCodePrefix", bought AS "OrderPurchaseTimestamp",
         delivered AS "OrderDeliveredCustomerDate", price AS "Price", freight AS "FreightValue", price + freight AS "TotalItemValue", ship_days AS "ShippingDays",
         way_days AS "DeliveryDays", o.total_days AS "TotalDays", coalesce(is_delayed, false) AS "IsDelayed", delay_days AS "DelayDays",
         c.state <> s.state AS "IsCrossState", pay1.type AS "PaymentType"
  FROM i JOIN o USING (order_id) JOIN c ON c.customer_id = o.customer_id JOIN s ON s.seller_id = i.seller_id LEFT JOIN pay1 ON pay1.order_id = i.order_id),
e AS (
  SELECT f.*, p.category_en AS "ProductCategoryNameEnglish", p.size_category AS "SizeCategory", c.state AS "CustomerState", s.state AS "SellerState"
  FROM f JOIN p ON p.product_id = f."ProductID" JOIN c ON c.customer_id = f."CustomerID" JOIN s ON s.seller_id = f."SellerID")
"""
ORDERS = 'count(DISTINCT "OrderID") AS "OrdersCount"'
CUSTOMERS = 'count(DISTINCT "CustomerID") AS "UniqueCustomers"'
SALES = 'sum("Price") AS "TotalSales"'
ITEM = 'CAST(sum("Price") AS DOUBLE) / count(*) AS "AvgItemPrice"'
SHIP = 'CAST(sum("FreightValue") AS DOUBLE) / count(*) AS "AvgShippingCost"'
TIME = 'CAST(sum("TotalDays") AS DOUBLE) / nullif(count("TotalDays"), 0) AS "AvgDeliveryTime"'
LATE = 'count(DISTINCT CASE WHEN "IsDelayed" THEN "OrderID" END) AS "DelayedOrders"'
RATE = 'CAST(count(DISTINCT CASE WHEN "IsDelayed" THEN "OrderID" END) AS DOUBLE) / count(DISTINCT "OrderID") AS "DelayRate"'
CAT = '"ProductCategoryNameEnglish"'


def add(name: str, sql: str | None = None, base: bool = True) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            SQL[name] = (BASE if base else "") + sql
        return query

    return keep


def on_star(name: str, sql: str, form: Callable[[dict[str, DataFrame]], DataFrame]) -> None:
    add(name, sql)(lambda spark, sf_dir: form(D.star(spark, sf_dir)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_dates(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as text, so that both engines hand over the same."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


def for_marts(t: dict[str, DataFrame], *more: str) -> tuple[DataFrame, DataFrame]:
    """(enriched, sales) written with what the eight marts take, and marked; more: columns that sales keeps besides."""
    sales = M.marked(t["fact_sales"], [("PaymentType",)])
    return written(M.for_marts(M.marked(t["enriched"])), "enriched"), written(M.for_marts(sales, *more), "sales")


# Marts.
on_star("a1_sales_by_category", f"SELECT {CAT}, {ORDERS}, {CUSTOMERS}, {SALES}, {ITEM}, {TIME}, {LATE} FROM e GROUP BY 1", lambda t: M.sales_by_category(t["enriched"]))
on_star("a2_sales_by_state", f'SELECT "CustomerState", {ORDERS}, {CUSTOMERS}, {SALES}, {ITEM}, {TIME} FROM e GROUP BY 1', lambda t: M.sales_by_state(t["enriched"]))
on_star("a3_monthly_sales", f'SELECT year("OrderPurchaseTimestamp") AS "Year", month("OrderPurchaseTimestamp") AS "Month", {ORDERS}, {CUSTOMERS}, {SALES}, {ITEM} FROM e GROUP BY 1, 2', lambda t: M.monthly_sales(t["enriched"]))
on_star("a4_order_status", f'SELECT {CAT}, "StatusID" AS "OrderStatus", {ORDERS}, {SALES}, {CUSTOMERS} FROM e GROUP BY 1, 2', lambda t: M.order_status(t["enriched"]))
on_star("a5_cross_state_analysis", f'SELECT {CAT}, "IsCrossState", {ORDERS}, {SALES}, {TIME}, {RATE} FROM e GROUP BY 1, 2', lambda t: M.cross_state_analysis(t["enriched"]))
on_star("a6_seller_performance", f'SELECT "SellerID", "SellerState", {ORDERS}, {SALES}, {SHIP}, {TIME}, {LATE}, {RATE} FROM e GROUP BY 1, 2', lambda t: M.seller_performance(t["enriched"]))
on_star("a7_size_analysis", f'SELECT {CAT}, "SizeCategory", {ORDERS}, {SALES}, {SHIP} FROM e GROUP BY 1, 2', lambda t: M.size_analysis(t["enriched"]))
ORDER_VALUE = 'CAST(sum("Price") AS DOUBLE) / count(DISTINCT "OrderID") AS "AvgOrderValue"'
on_star("a8_payment_methods", f'SELECT "PaymentType", {ORDERS}, {SALES}, {ORDER_VALUE}, {CUSTOMERS} FROM f WHERE "PaymentType" IS NOT NULL GROUP BY 1', lambda t: M.payment_methods(t["fact_sales"]))
on_star("a8b_payment_methods_two_level", f'SELECT "PaymentType", {ORDERS}, {SALES}, {ORDER_VALUE}, {CUSTOMERS} FROM f GROUP BY 1', lambda t: M.payment_methods_two_level(t["fact_sales"]))
on_star("a9_orders_by_date_state", f"""SELECT year("OrderPurchaseTimestamp") AS "Year", month("OrderPurchaseTimestamp") AS "Month", monthname("OrderPurchaseTimestamp") AS "MonthName", c.state AS "CustomerState",
  {ORDERS}, sum("TotalItemValue") AS "TotalValue" FROM f JOIN c ON c.customer_id = f."CustomerID" GROUP BY 1, 2, 3, 4""", lambda t: M.orders_by_date_state(t["fact_sales"], t["dim_date"], t["dim_customer"]))  # fmt: skip
on_star("a10_product_category_sales", f'SELECT {CAT}, {ORDERS}, sum("TotalItemValue") AS "TotalValue", CAST(sum("Price") AS DOUBLE) / count(*) AS "AvgPrice" FROM e GROUP BY 1', lambda t: M.product_category_sales(t["enriched"]))
on_star("a11_status_counts", "SELECT order_status, count(*) AS n_orders FROM o GROUP BY 1", lambda t: M.status_counts(t["orders"]))
GEO = ", g AS (SELECT s_nationkey AS zip, s_name AS city, n_name AS state, CAST(s_acctbal AS DECIMAL(12,2)) AS lat, CAST(s_suppkey AS DECIMAL(12,2)) AS lng FROM supplier JOIN nation ON s_nationkey = n_nationkey)"
on_star("a12_geo_centroid", GEO + ' SELECT zip AS "ZipCodePrefix", min(city) AS "City", arg_min(state, city) AS "State", round(avg(CAST(lat AS DOUBLE)), 6) AS "Latitude", round(avg(CAST(lng AS DOUBLE)), 6) AS "Longitude" FROM g GROUP BY 1',
        lambda t: S.geo_centroid(t["geolocation"]).withColumns({c: F.round(c, 6) for c in ("Latitude", "Longitude")}))
on_star("a13_date_bounds", "SELECT strftime(date_trunc('month', min(bought)), '%Y-%m-%d') AS first_day, strftime(max(coalesce(due, bought)), '%Y-%m-%d') AS last_day FROM o", lambda t: text_dates(S.date_bounds(t["orders"]), "first_day", "last_day"))
on_star("a14_metrics_summary", """SELECT count(*) AS sales_rows, count(DISTINCT "OrderID") AS orders, count(*) FILTER (NOT "IsCrossState") AS same_state, count(*) FILTER ("IsCrossState") AS cross_state,
  count(*) FILTER ("IsDelayed") AS delayed, sum("TotalItemValue") AS gross_value FROM f""", lambda t: M.metrics_summary(t["fact_sales"]))  # fmt: skip
on_star("a15_reconcile_totals", """SELECT m AS mart, t AS fact_total, t AS mart_total, true AS matches FROM (SELECT unnest(['sales_by_state', 'sales_by_category', 'monthly_sales', 'order_status', 'cross_state_analysis', 'seller_performance', 'size_analysis', 'payment_methods']) AS m),
  (SELECT sum("Price") AS a, sum("Price") FILTER ("PaymentType" IS NOT NULL) AS b FROM f), LATERAL (SELECT CASE WHEN m = 'payment_methods' THEN b ELSE a END AS t)""",
        lambda t: (lambda rich, sales: M.reconcile_totals(sales, M.all_marts(rich, sales)))(*for_marts(t)))

# Dimensions and facts.
VALID = ", TIMESTAMP '2018-04-01' AS \"RowEffectiveDate\", CAST(NULL AS TIMESTAMP) AS \"RowExpirationDate\", true AS \"CurrentFlag\""
on_star("d1_dim_customer", f'SELECT customer_id AS "CustomerID", uname AS "CustomerUniqueID", zip AS "CustomerZipCodePrefix", city AS "CustomerCity", state AS "CustomerState"{VALID} FROM c', lambda t: t["dim_customer"])
on_star("d2_dim_product", f"""SELECT product_id AS "ProductID", category AS "ProductCategoryName", category_en AS "ProductCategoryNameEnglish", CAST(length AS DECIMAL(10,3)) AS "ProductWeightG", CAST(length AS DECIMAL(10,3)) AS "ProductLengthCm",
  CAST(height AS DECIMAL(10,3)) AS "ProductHeightCm", CAST(width AS DECIMAL(10,3)) AS "ProductWidthCm", CAST(volume AS DECIMAL(32,9)) AS "ProductVolumeCm3", size_category AS "SizeCategory"{VALID} FROM p""", lambda t: t["dim_product"])  # fmt: skip
on_star("d3_dim_seller", f'SELECT seller_id AS "SellerID", zip AS "SellerZipCodePrefix", city AS "SellerCity", state AS "SellerState"{VALID} FROM s', lambda t: t["dim_seller"])
on_star("d4_dim_geography", GEO + f""" SELECT zip AS "ZipCodePrefix", city AS "City", state AS "State", lat AS "Latitude", lng AS "Longitude"{VALID}, CAST(NULL AS VARCHAR) AS "Region" FROM g
  QUALIFY row_number() OVER (PARTITION BY zip ORDER BY city, state, lat, lng) = 1""", lambda t: t["dim_geography"])  # fmt: skip
on_star("d5_dim_date", """, d AS (SELECT CAST(unnest(generate_series(min(bought), max(bought), INTERVAL 1 DAY)) AS DATE) AS d FROM o)
  SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS "DateKey", CAST(strftime(d, '%Y%m%d') AS INT) AS "DateID", strftime(d, '%Y-%m-%d') AS "Date", year(d) AS "Year", month(d) AS "Month", day(d) AS "Day", quarter(d) AS "Quarter", week(d) AS "WeekOfYear",
  dayofweek(d) + 1 AS "DayOfWeek", dayofweek(d) IN (0, 6) AS "IsWeekend", monthname(d) AS "MonthName", dayname(d) AS "DayName", year(d + INTERVAL 6 MONTH) AS "FiscalYear", quarter(d + INTERVAL 6 MONTH) AS "FiscalQuarter",
  CAST(NULL AS VARCHAR) AS "Holiday", false AS "IsHoliday" FROM d""", lambda t: text_dates(S.dim_date(S.date_bounds(t["orders"], to_estimate=False), fiscal_start_month=7), "Date"))  # fmt: skip
on_star("d7_fact_sales", "SELECT * FROM f", lambda t: t["fact_sales"])
on_star("d8_fact_reviews", """SELECT event_id AS "OrderID", event_id AS "ReviewID", customer_id AS "CustomerID", CAST(strftime(bought, '%Y%m%d') AS INT) AS "DateKey", 1 + event_id % 7 AS "ReviewScore", props AS "ReviewCommentMessage",
  ts AS "ReviewCreationDate", ts + to_days(CAST(event_id % 10 AS INT)) AS "ReviewAnswerTimestamp", event_id % 10 AS "ReviewResponseDays" FROM events JOIN o ON order_id = event_id WHERE event_type = 'view'""", lambda t: t["fact_reviews"])  # fmt: skip
FLAG_NAMES = ["StatusID", "StatusDescription", "IsApproved", "IsDelivered", "IsShipped", "IsCancelled"]
on_star("d6_status_usage", """SELECT x.s AS "StatusID", x.d AS "StatusDescription", x.s IN ('APPROVED', 'SHIPPED', 'DELIVERED') AS "IsApproved", x.s = 'DELIVERED' AS "IsDelivered", x.s IN ('SHIPPED', 'DELIVERED') AS "IsShipped", x.s = 'CANCELLED' AS "IsCancelled", count(order_id) AS n_orders
  FROM (SELECT upper(d) AS s, d FROM (SELECT unnest(['Created', 'Approved', 'Shipped', 'Delivered', 'Cancelled', 'Unavailable']) AS d)) x LEFT JOIN o ON o.order_status = x.s GROUP BY ALL""",
        lambda t: S.dim_order_status(t["orders"].sparkSession).join(t["orders"], F.col("StatusID") == F.col("order_status"), "left").groupBy(*FLAG_NAMES).agg(F.count("order_id").alias("n_orders")))

# Projections and parsing.
on_star("p5_order_columns", """SELECT order_id, order_status, year(bought) AS order_year, month(bought) AS order_month, day(bought) AS order_day, ship_days AS shipping_time_days, way_days AS delivery_time_days, total_days AS total_delivery_time_days,
  CAST(is_delayed AS VARCHAR) AS is_delayed, delay_days, approved IS NOT NULL AS is_approved, shipped IS NOT NULL AS is_shipped, delivered IS NOT NULL AS is_delivered, coalesce(ship_days, -1) AS shipping_days, coalesce(way_days, -1) AS delivery_days, coalesce(total_days, -1) AS total_days FROM o""",
        lambda t: t["orders"].select("order_id", "order_status", "order_year", "order_month", "order_day", "shipping_time_days", "delivery_time_days", "total_delivery_time_days", F.col("is_delayed").cast("string").alias("is_delayed"), "delay_days", "is_approved", "is_shipped", "is_delivered", "shipping_days", "delivery_days", "total_days"))
add("p5b_timestamp_status", "SELECT order_id, CASE WHEN delivered IS NOT NULL THEN 'DELIVERED' WHEN shipped IS NOT NULL THEN 'SHIPPED' WHEN approved IS NOT NULL THEN 'APPROVED' ELSE 'CREATED' END AS order_status FROM o")(
    lambda spark, sf_dir: D.raw_orders(spark, sf_dir).select("order_id", derive.derive_status(F.col("order_status"), terminal={}).alias("order_status"))
)
on_star("p12_volume_and_size", 'SELECT size_category AS "SizeCategory", count(*) AS n, CAST(sum(volume) AS DECIMAL(38,3)) AS volume FROM p GROUP BY 1', lambda t: t["dim_product"].groupBy("SizeCategory").agg(F.count("*").alias("n"), F.sum("ProductVolumeCm3").cast("decimal(38,3)").alias("volume")))
on_star("p13_cross_flag", 'SELECT "IsCrossState", count(*) AS n FROM f GROUP BY 1', lambda t: t["fact_sales"].groupBy("IsCrossState").agg(F.count("*").alias("n")))
on_star("p16_null_profile", """SELECT * FROM (SELECT 'order_approved_at' AS column_name, count(*) FILTER (approved IS NULL) AS missing FROM o UNION ALL SELECT 'order_delivered_carrier_date', count(*) FILTER (shipped IS NULL) FROM o
  UNION ALL SELECT 'order_delivered_customer_date', count(*) FILTER (delivered IS NULL) FROM o UNION ALL SELECT 'customer_id', count(*) FILTER (customer_id IS NULL) FROM o) WHERE missing > 0""",
        lambda t: parsing.null_profile(t["orders"], ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "customer_id"]))
on_star("p17_valid_scores", "SELECT event_id AS review_id, 1 + event_id % 7 AS review_score FROM events WHERE event_type = 'view' AND event_id % 7 < 5", lambda t: derive.valid_scores(t["order_reviews"]).select("review_id", "review_score"))


@add("p1_normalize", """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INT) END AS k, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) END AS at FROM events""", base=False)
def p1_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymart.contracts import contract

    text = table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS event_id", "CASE WHEN event_id % 10 = 0 THEN concat(get_json_object(props, '$.k'), 'x') ELSE concat(' ', get_json_object(props, '$.k')) END AS kk",
        "CASE WHEN event_id % 7 = 0 THEN '  ' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS at",
    )
    return parsing.normalize(text, contract("events", "event_id integer, kk>k integer?, at timestamp?")).select("event_id", "k", "at")


add("p2_fill_and_lower", "SELECT event_id, lower(CASE WHEN event_id % 4 = 0 THEN 'UNKNOWN' ELSE upper(event_type) END) AS kind FROM events", base=False)(
    lambda spark, sf_dir: parsing.lower_col(parsing.fill_null(table(spark, sf_dir, "events").selectExpr("event_id", "CASE WHEN event_id % 4 <> 0 THEN upper(event_type) END AS kind"), {"kind": "UNKNOWN"}), "kind")
)
add("p3_run_metadata", "SELECT r_regionkey, 'b1' AS batch_id, 'f1' AS source_file_id, TIMESTAMP '2018-04-01' AS ingestion_timestamp, TIMESTAMP '2018-04-02' AS processing_timestamp, 1 AS contract_version FROM region", base=False)(
    lambda spark, sf_dir: parsing.add_run_metadata(table(spark, sf_dir, "region").select("r_regionkey"), "b1", "f1", "2018-04-01 00:00:00", "2018-04-02 00:00:00", 1)
)
add("s3_snake_case_columns", "SELECT c_custkey AS cust_key, c_name AS cust_name FROM customer", base=False)(
    lambda spark, sf_dir: parsing.snake_case_columns(table(spark, sf_dir, "customer").selectExpr("c_custkey AS `Cust Key`", "c_name AS `Cust-Name`"))
)

# Row, key and reference quality.


def flagged_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rules = [Q.in_order([("o_orderdate", "l_shipdate")]), Q.in_range({"l_linenumber": (1, 6), "l_quantity": (2, 49)}), Q.not_negative(["l_tax"], {"l_discount": 0})]
    return Q.with_reasons(rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "o_orderdate", "l_quantity", "l_tax", "l_discount"), rules)


FLAGS = """
WITH x AS (SELECT l.*, o_orderdate, l_shipdate < o_orderdate AS t, l_linenumber < 1 OR l_linenumber > 6 OR l_quantity < 2 OR l_quantity > 49 AS r, l_tax < 0 OR l_discount < 0 AS m FROM lineitem l JOIN orders ON l_orderkey = o_orderkey)
"""
add("q1_reject_rows", FLAGS + "SELECT l_orderkey, l_linenumber, array_to_string(list_filter([CASE WHEN t THEN 'impossible_timestamp' END, CASE WHEN m THEN 'invalid_monetary_value' END, CASE WHEN r THEN 'invalid_range' END], lambda v: v IS NOT NULL), ',') AS codes FROM x WHERE t OR r OR m", base=False)(
    lambda spark, sf_dir: Q.split_rows(flagged_items(spark, sf_dir))[1].select("l_orderkey", "l_linenumber", F.array_join("rejection_codes", ",").alias("codes"))
)
add("q6_valid_rows", FLAGS + "SELECT l_orderkey, l_linenumber, l_partkey FROM x WHERE NOT (t OR r OR m)", base=False)(lambda spark, sf_dir: Q.split_rows(flagged_items(spark, sf_dir))[0].select("l_orderkey", "l_linenumber", "l_partkey"))
add("q14_reason_counts", FLAGS + "SELECT 'impossible_timestamp' AS reason, count(*) AS n_rows FROM x WHERE t UNION ALL SELECT 'invalid_range', count(*) FROM x WHERE r", base=False)(lambda spark, sf_dir: Q.reason_counts(Q.split_rows(flagged_items(spark, sf_dir))[1]))
add("q15_quality_summary", FLAGS + "SELECT 'items' AS dataset, count(*) AS input_rows, count(*) FILTER (NOT (t OR r OR m)) AS valid_rows, count(*) FILTER (t OR r OR m) AS rejected_rows, CASE WHEN count(*) FILTER (t OR r OR m) > 0 THEN 'PASSED_WITH_REJECTIONS' ELSE 'PASSED' END AS outcome FROM x", base=False)(lambda spark, sf_dir: Q.quality_summary({"items": flagged_items(spark, sf_dir)}))
add("q15_severity_counts", FLAGS + "SELECT 'reject-row' AS severity, (SELECT count(*) FROM x WHERE t) + (SELECT count(*) FROM x WHERE r) AS n", base=False)(lambda spark, sf_dir: Q.severity_counts({"items": flagged_items(spark, sf_dir)}))
add("q17_violations", FLAGS + """SELECT 'items' AS dataset, l_orderkey || '|' || l_linenumber || '|' || l_partkey AS row_id, rule, 'reject-row' AS severity FROM x, LATERAL (SELECT unnest([CASE WHEN t THEN 'impossible_timestamp' END, CASE WHEN r THEN 'invalid_range' END]) AS rule) WHERE rule IS NOT NULL""", base=False)(
    lambda spark, sf_dir: Q.violations({"items": flagged_items(spark, sf_dir)}, {"items": ["l_orderkey", "l_linenumber", "l_partkey"]})
)
add("q17_overall_status", FLAGS + "SELECT CASE WHEN count(*) FILTER (t OR r OR m) > 0 THEN 'accepted-with-rejections' ELSE 'accepted' END AS status FROM x", base=False)(lambda spark, sf_dir: Q.overall_status(Q.violations({"items": flagged_items(spark, sf_dir)}, {"items": ["l_orderkey"]})))


@add("q8_deduplicate", "SELECT o.o_orderkey, any_value(o_custkey) AS o_custkey, any_value(o_orderstatus) AS o_orderstatus, (SELECT count(*) - count(DISTINCT l_orderkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS n_removed FROM lineitem JOIN orders o ON l_orderkey = o_orderkey GROUP BY 1", base=False)
def q8_deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders repeated once an item: equal rows of a key become one."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey")
    once, removed = Q.deduplicate(rows, ["o_orderkey"])
    return once.withColumn("n_removed", F.lit(removed).cast("long"))


add("q8_duplicates_removed", "SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_distinct, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_removed FROM lineitem", base=False)(lambda spark, sf_dir: Q.duplicates_removed(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")))
add("q9_conflicting_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n_versions FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem) GROUP BY 1, 2 HAVING count(*) > 1", base=False)(lambda spark, sf_dir: Q.conflicting_keys(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber"]))
add("q10_flag_duplicate_keys", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'duplicate_fact_grain' ELSE '' END AS codes FROM lineitem", base=False)(
    lambda spark, sf_dir: Q.flag_duplicate_keys(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"], "duplicate_fact_grain").select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("rejection_codes", ",").alias("codes"))
)
add("q20_grain_violations", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1", base=False)(lambda spark, sf_dir: Q.grain_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]))
PARENTS = "FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey"
add("q11_reject_orphans", f"SELECT o_orderkey {PARENTS} WHERE c_custkey IS NULL", base=False)(lambda spark, sf_dir: Q.reject_orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").filter("c_acctbal >= 5000"), ["o_custkey"], ["c_custkey"])[1].select("o_orderkey"))
SQL["q11_reject_orphans"] = SQL["q11_reject_orphans"].replace(">= 0", ">= 5000")


def cascade(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    frames = {
        "customers": Q.with_reasons(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), [Q.not_negative([], {"c_acctbal": 5000})]),
        "orders": table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "items": table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"),
    }
    return Q.cascade_references(frames, [Q.Reference("orders", ("o_custkey",), "customers", ("c_custkey",)), Q.Reference("items", ("l_orderkey",), "orders", ("o_orderkey",))])


add("q12_cascade_references", """SELECT 'customers' AS dataset, count(*) FILTER (c_acctbal < 5000) AS rejected_rows, count(*) AS input_rows FROM customer
UNION ALL SELECT 'orders', count(*) FILTER (c_acctbal IS NULL OR c_acctbal < 5000), count(*) FROM orders LEFT JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'items', count(*) FILTER (c_acctbal IS NULL OR c_acctbal < 5000), count(*) FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey""", base=False)(
    lambda spark, sf_dir: Q.quality_summary(cascade(spark, sf_dir)).select("dataset", "rejected_rows", "input_rows")
)
add("q13_missing_dimension_lookup", "SELECT l_orderkey, l_linenumber FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 5) ON l_partkey = p_partkey WHERE p_partkey IS NULL", base=False)(
    lambda spark, sf_dir: Q.missing_dimension_lookup(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").filter("p_size > 5"), ["l_partkey"], ["p_partkey"])[1].select("l_orderkey", "l_linenumber")
)
# A dataset for each customer: orders of 1000 or less are rejected, those that 97 divides get lost.
REJECTED, LOST = "o_totalprice <= 1000", "o_totalprice > 1000 AND o_orderkey % 97 = 0"
add("q16_reconcile_counts", f"SELECT o_custkey AS dataset, count(*) AS source_rows, count(*) FILTER ({REJECTED}) AS rejected_rows, count(*) FILTER (NOT ({REJECTED}) AND NOT ({LOST})) AS processed_rows, CAST(0 AS BIGINT) AS duplicate_rows FROM orders GROUP BY 1 HAVING count(*) FILTER ({LOST}) > 0", base=False)(
    lambda spark, sf_dir: Q.reconcile_counts(
        table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("dataset"))
        .agg(F.count("*").alias("source_rows"), F.count_if(F.expr(REJECTED)).alias("rejected_rows"), F.count_if(~F.expr(REJECTED) & ~F.expr(LOST)).alias("processed_rows"), F.lit(0).cast("long").alias("duplicate_rows"))
    )
)



@add("q8_deduplicate_after_rules", """WITH k AS (SELECT c_custkey AS k FROM customer),
  n AS (SELECT count(*) AS a, count(*) FILTER (k % 3 = 0) AS a3, count(*) FILTER (k % 5 = 0) AS a5, count(*) FILTER (k % 15 = 0) AS a15, count(*) FILTER (k % 7 = 0 AND k % 5 <> 0) AS clash, count(*) FILTER (k % 3 = 0 AND k % 5 <> 0) AS twice FROM k)
  SELECT 'people' AS dataset, a + a3 + clash AS source_rows, a5 + a15 + 2 * clash AS rejected_rows, a - a5 - clash AS processed_rows, twice AS duplicate_rows FROM n""", base=False)
def q8_deduplicate_after_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as text: every third again with blanks, the balance of every fifth unreadable, of the other sevenths a row that differs. Counts that reconcile."""
    from tallymart.contracts import contract

    c = contract("people", "id integer, name string, balance decimal(12,2)", "id")
    rows = table(spark, sf_dir, "customer").selectExpr("CAST(c_custkey AS STRING) AS id", "c_name AS name", "CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) END AS balance")
    raw = rows.unionByName(rows.filter("id % 3 = 0").withColumn("name", F.concat(F.lit(" "), "name", F.lit("  ")))).unionByName(rows.filter("id % 7 = 0 AND id % 5 <> 0").withColumn("name", F.lit("another")))
    once = written(Q.drop_repeated_accepted(Q.with_reasons(parsing.normalize(raw, c), [Q.required(["id"]), Q.unparsed(c)])), "people")
    counts = Q.three_way_counts({"people": Q.flag_duplicate_keys(once, ["id"], among=F.size("rejection_codes") == 0)})
    found = counts.join(raw.agg(F.lit("people").alias("dataset"), F.count("*").alias("source_rows")), "dataset")
    return found.select("dataset", "source_rows", "rejected_rows", "processed_rows", "duplicate_rows")


# Joins.
on_star("j1_join_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey", lambda t: S.join_inner(t["orders"], t["customers"], ["customer_id"]).select(F.col("order_id").alias("o_orderkey"), F.col("customer_unique_id").alias("c_name")))
on_star("j2_join_left", "SELECT o.order_id, pay1.type AS payment_type FROM o LEFT JOIN pay1 USING (order_id)", lambda t: S.join_left(t["orders"].select("order_id"), S.representative(t["order_payments"].select("order_id", "payment_sequential", "payment_type"), ["order_id"], ["payment_sequential", "payment_type"]), ["order_id"]).select("order_id", "payment_type"))
on_star("j3_translate", "SELECT product_id, category_en AS product_category_name_english FROM p", lambda t: t["products"].select("product_id", "product_category_name_english"))
add("j4_orphans", "SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 3000)", base=False)(lambda spark, sf_dir: S.orphans(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier").filter("s_acctbal >= 3000"), "l_suppkey", "s_suppkey").select("l_orderkey", "l_suppkey"))
add("j5_match_flag", "SELECT has_parent, count(*) AS n FROM (SELECT o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 3000) AS has_parent FROM orders) GROUP BY 1", base=False)(lambda spark, sf_dir: S.with_match_flag(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").filter("c_acctbal >= 3000"), "o_custkey", "c_custkey").groupBy("has_parent").agg(F.count("*").alias("n")))
add("j6_join_null_safe", """WITH a AS (SELECT DISTINCT CASE WHEN event_id % 5 > 0 THEN event_id % 5 END AS k, event_type AS x FROM events), b AS (SELECT k, count(*) AS n FROM a GROUP BY k) SELECT a.k, x, n FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k""", base=False)(
    lambda spark, sf_dir: (lambda a: S.join_null_safe(a, a.groupBy("k").agg(F.count("*").alias("n")), ["k"]).select("k", "x", "n"))(table(spark, sf_dir, "events").selectExpr("CASE WHEN event_id % 5 > 0 THEN event_id % 5 END AS k", "event_type AS x").distinct())
)
on_star("j7_lookup_keys", ', k AS (SELECT seller_id, row_number() OVER (ORDER BY seller_id) AS sk FROM s) SELECT "OrderID", "OrderItemID", "ProductID", sk AS "SellerKey" FROM f JOIN k ON seller_id = "SellerID"',
        lambda t: S.lookup_keys(t["fact_sales"], S.allocate_keys(t["dim_seller"], t["dim_seller"].select(F.lit(0).alias("SellerKey")), "SellerID", "SellerKey"), "SellerID", "SellerKey").select("OrderID", "OrderItemID", "ProductID", "SellerKey"))
on_star("j12_enrich", 'SELECT "CustomerState", "SellerState", "SizeCategory", count(*) AS n FROM e GROUP BY ALL', lambda t: t["enriched"].groupBy("CustomerState", "SellerState", "SizeCategory").agg(F.count("*").alias("n")))

# Windows, sets, identity.
on_star("w1_representative", "SELECT order_id, type AS payment_type FROM pay1", lambda t: S.representative(t["order_payments"].select("order_id", "payment_sequential", "payment_type"), ["order_id"], ["payment_sequential", "payment_type"]).select("order_id", "payment_type"))
add("w3_allocate_keys", "SELECT o_orderkey, o_custkey, o_orderstatus, 100000 + row_number() OVER (ORDER BY o_orderkey) AS order_sk FROM orders", base=False)(lambda spark, sf_dir: S.allocate_keys(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), table(spark, sf_dir, "region").select(F.lit(100000).alias("order_sk")), "o_orderkey", "order_sk"))
add("w4_next_effective", 'SELECT user_id, event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "RowExpirationDate" FROM events', base=False)(lambda spark, sf_dir: S.next_effective(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], "ts"))
add("o3_diff", "(SELECT l_suppkey, 'expected' AS side FROM (SELECT l_suppkey FROM lineitem WHERE l_quantity < 10 EXCEPT ALL SELECT l_suppkey FROM lineitem WHERE l_quantity > 40)) UNION ALL (SELECT l_suppkey, 'actual' FROM (SELECT l_suppkey FROM lineitem WHERE l_quantity > 40 EXCEPT ALL SELECT l_suppkey FROM lineitem WHERE l_quantity < 10))", base=False)(
    lambda spark, sf_dir: P.diff(table(spark, sf_dir, "lineitem").filter("l_quantity < 10").select("l_suppkey"), table(spark, sf_dir, "lineitem").filter("l_quantity > 40").select("l_suppkey"))
)
on_star("o6_date_spine", "SELECT count(*) AS n_days, strftime(min(d), '%Y-%m-%d') AS first_day, strftime(max(d), '%Y-%m-%d') AS last_day FROM (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', min(bought)) AS TIMESTAMP), max(due), INTERVAL 1 DAY)) AS DATE) AS d FROM o)", lambda t: text_dates(S.date_spine(S.date_bounds(t["orders"])).agg(F.count("*").alias("n_days"), F.min("Date").alias("first_day"), F.max("Date").alias("last_day")), "first_day", "last_day"))
CUSTOMER_JSON = """'{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || CASE WHEN c_custkey % 9 = 0 THEN 'null' ELSE CAST(c_nationkey AS VARCHAR) END || ',"balance":"' || CAST(c_acctbal AS DECIMAL(12,2)) || '","day":"' || strftime(DATE '2020-01-01' + CAST(c_custkey % 100 AS INT), '%Y-%m-%d') || '"}'"""
CUSTOMER = ("c_custkey", "c_name", "CASE WHEN c_custkey % 9 <> 0 THEN c_nationkey END AS c_nationkey", "CAST(c_acctbal AS DECIMAL(12,2)) AS balance", "date_add(DATE'2020-01-01', CAST(c_custkey % 100 AS INT)) AS day")
add("f2_record_hash", f'SELECT c_custkey, sha256({CUSTOMER_JSON}) AS "RecordHash" FROM customer', base=False)(lambda spark, sf_dir: I.with_record_hash(table(spark, sf_dir, "customer").selectExpr(*CUSTOMER)).select("c_custkey", "RecordHash"))
add("f3_verify_record_hash", "SELECT c_custkey FROM customer WHERE c_custkey % 10 = 3", base=False)(
    lambda spark, sf_dir: I.verify_record_hash(I.with_record_hash(table(spark, sf_dir, "customer").selectExpr(*CUSTOMER)).withColumn("c_name", F.when(F.col("c_custkey") % 10 == 3, "changed").otherwise(F.col("c_name")))).select("c_custkey")
)
add("f4_tracked_hash", """SELECT c_custkey, sha256('{"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '"}') AS tracked FROM customer""", base=False)(lambda spark, sf_dir: (lambda df: df.select("c_custkey", I.tracked_hash(df, ["c_mktsegment", "c_name"]).alias("tracked")))(table(spark, sf_dir, "customer")))
SIGNED = """'{"balance":"' || CAST(c_acctbal AS DECIMAL(12,2)) || '","c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"' || CASE WHEN c_custkey % 9 = 0 THEN '' ELSE ',"c_nationkey":' || c_nationkey END || ',"day":"' || strftime(DATE '2020-01-01' + CAST(c_custkey % 100 AS INT), '%Y-%m-%d') || '"}'"""
add("f1_row_signature", f"SELECT c_custkey, sha256({SIGNED}) AS signature FROM customer", base=False)(
    lambda spark, sf_dir: (lambda df: df.select("c_custkey", Q.row_signature(df).alias("signature")))(table(spark, sf_dir, "customer").selectExpr(*CUSTOMER).withColumn("balance", F.col("balance").cast("string")))
)


def fingerprint_sql(json: str, source: str) -> str:
    """n_rows, sum_first and sum_second of rows given as their JSON."""
    part = lambda at: f"CAST(coalesce(sum(CAST('0x' || substr(sha256({json}), {at}, 15) AS BIGINT)), 0) AS VARCHAR)"
    return f"SELECT count(*) AS n_rows, {part(1)} AS sum_first, {part(16)} AS sum_second FROM {source}"


add("f5_table_fingerprint", fingerprint_sql(CUSTOMER_JSON, "customer"), base=False)(lambda spark, sf_dir: I.table_fingerprint(table(spark, sf_dir, "customer").selectExpr(*CUSTOMER)))
add("f5_file_fingerprint")(lambda spark, sf_dir: I.file_fingerprint(spark, f"{sf_dir}/orders.parquet"))


@add("f6_publication_fingerprint")
def f6_publication_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sixteen published tables: dimensions, facts and marts."""
    t = D.star(spark, sf_dir)
    columns = t["fact_sales"].columns
    rich, sales = for_marts(t, *columns)
    tables = {n: t[n] for n in ("dim_customer", "dim_product", "dim_seller", "dim_geography", "dim_date", "fact_reviews")} | {"fact_sales": sales.select(*columns), "dim_order_status": S.dim_order_status(spark)}
    return I.publication_fingerprint(I.fingerprints({**tables, **M.all_marts(rich, sales)}), "batch-1", ["contract-1"])


NATION_JSON, REGION_JSON = """'{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}'""", """'{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name || '"}'"""
add("f6_two_tables", f"""WITH t AS (SELECT 'nation' AS d, * FROM ({fingerprint_sql(NATION_JSON, "nation")}) UNION ALL SELECT 'region', * FROM ({fingerprint_sql(REGION_JSON, "region")}))
  SELECT sha256('batch-1' || chr(10) || 'contract-1' || chr(10) || string_agg(d || '|' || sum_first || ':' || sum_second || '|' || n_rows, chr(10) ORDER BY d)) AS fingerprint FROM t""", base=False)(
    lambda spark, sf_dir: I.publication_fingerprint(I.fingerprints({"nation": table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "region": table(spark, sf_dir, "region").select("r_regionkey", "r_name")}), "batch-1", ["contract-1"])
)


# History: a user's last event type of each week, from the week's start.
WEEKS = """
WITH w AS (SELECT user_id, date_trunc('week', ts) AS week, arg_max(event_type, (ts, event_id)) AS kind FROM events GROUP BY 1, 2),
v0 AS (SELECT *, lag(kind) OVER u AS before, row_number() OVER u AS n FROM w WINDOW u AS (PARTITION BY user_id ORDER BY week)),
v AS (SELECT user_id, kind, CASE WHEN n = 1 THEN TIMESTAMP '1900-01-01' ELSE CAST(week AS TIMESTAMP) END AS effective FROM v0 WHERE before IS NULL OR before <> kind),
h AS (SELECT *, lead(effective) OVER (PARTITION BY user_id ORDER BY effective) AS expiration FROM v)
"""


def weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("week", F.date_trunc("week", "ts"))
    return rows.groupBy("user_id", "week").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("kind")).withColumn("hash", F.sha2("kind", 256))


def user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.scd2_backfill(weeks(spark, sf_dir), ["user_id"], "week", "hash")


HISTORY = "SELECT user_id, kind, effective, expiration, expiration IS NULL AS is_current FROM h"
add("h1_scd2_backfill", WEEKS + HISTORY, base=False)(lambda spark, sf_dir: user_history(spark, sf_dir).select("user_id", "kind", "effective", "expiration", "is_current"))


@add("h1_scd2_apply", WEEKS + HISTORY, base=False)
def h1_scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the weeks at once, the rest a batch each: the same history."""
    rows = written(weeks(spark, sf_dir), "weeks")
    starts = [r[0] for r in rows.select("week").distinct().orderBy("week").collect()]  # one for each week of the table
    half = len(starts) // 2
    history = H.scd2_backfill(rows.filter(F.col("week") <= starts[half]), ["user_id"], "week", "hash")
    for start in starts[half + 1 :]:
        history = written(H.scd2_apply(history, rows.filter(F.col("week") == start), ["user_id"], "hash", "week"), "history")
    return history.select("user_id", "kind", "effective", "expiration", "is_current")


add("h2_scd2_conflicts", WEEKS + "SELECT user_id, 'same_time_other_content' AS reason FROM h WHERE effective > TIMESTAMP '1900-01-01' AND user_id % 3 = 0 GROUP BY 1", base=False)(
    lambda spark, sf_dir: (lambda h: H.scd2_conflicts(h, h.filter("effective > '1900-01-01' AND user_id % 3 = 0").groupBy("user_id").agg(F.max("effective").alias("at")).withColumn("hash", F.lit("other")), ["user_id"], "hash", "at"))(user_history(spark, sf_dir))
)
add("h3_scd2_integrity", WEEKS + "SELECT 'overlap' AS issue, (SELECT count(*) FROM h) - (SELECT count(DISTINCT user_id) FROM h) AS n UNION ALL SELECT 'several_current', (SELECT count(*) FROM (SELECT user_id FROM h GROUP BY 1 HAVING count(*) > 1))", base=False)(
    lambda spark, sf_dir: H.scd2_integrity(user_history(spark, sf_dir).withColumn("expiration", F.lit(None).cast("timestamp")).withColumn("is_current", F.lit(True)).withColumn("sk", F.monotonically_increasing_id()), ["user_id"], "sk")
)
RESOLVED = WEEKS + "SELECT event_id, h.kind FROM events e JOIN h ON e.user_id = h.user_id AND e.ts >= h.effective AND e.ts < coalesce(h.expiration, TIMESTAMP '9999-12-31')"
add("j8_interval_join", RESOLVED, base=False)(lambda spark, sf_dir: H.interval_join(table(spark, sf_dir, "events"), user_history(spark, sf_dir), ["user_id"], "ts").select("event_id", "kind"))
add("j8_as_of_versions", RESOLVED, base=False)(lambda spark, sf_dir: H.as_of_versions(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), user_history(spark, sf_dir), "user_id", "ts", "kind").select("event_id", "kind"))
add("j9_chained_lookup", WEEKS + "SELECT e.event_id, h.kind, g.kind AS manager_kind FROM events e JOIN h ON e.user_id = h.user_id AND e.ts >= h.effective AND e.ts < coalesce(h.expiration, TIMESTAMP '9999-12-31') JOIN h g ON g.user_id = length(h.kind) AND e.ts >= g.effective AND e.ts < coalesce(g.expiration, TIMESTAMP '9999-12-31')", base=False)(
    lambda spark, sf_dir: (
        lambda h: H.interval_join(
            H.interval_join(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), h.select("user_id", "kind", "effective", "expiration"), ["user_id"], "ts").drop("effective", "expiration").withColumn("manager", F.length("kind").cast("long")),
            h.select(F.col("user_id").alias("manager"), F.col("kind").alias("manager_kind"), "effective", "expiration"), ["manager"], "ts",
        ).select("event_id", "kind", "manager_kind")
    )(user_history(spark, sf_dir))
)
add("h4_resolve_event_time", WEEKS + "SELECT event_id, CAST(0 AS BIGINT) AS matches FROM events WHERE user_id % 5 = 0", base=False)(
    lambda spark, sf_dir: H.resolve_event_time(table(spark, sf_dir, "events"), user_history(spark, sf_dir).filter("user_id % 5 <> 0").withColumn("sk", F.xxhash64("user_id", "effective")), ["event_id"], ["user_id"], "ts", "sk")[1]
)
HOT = WEEKS + ", f AS (SELECT event_id, ts, CASE WHEN event_id % 2 = 0 THEN (SELECT min(user_id) FROM events) WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id FROM events)"


def hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of all events at one user, a seventh of the others at none."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    first = rows.agg(F.min("user_id")).first()[0]
    return rows.withColumn("user_id", F.when(F.col("event_id") % 2 == 0, F.lit(first)).when(F.col("event_id") % 7 != 0, F.col("user_id")))


add("j8_hot_key", HOT + "SELECT event_id, h.kind FROM f LEFT JOIN h ON f.user_id = h.user_id AND ts >= h.effective AND ts < coalesce(h.expiration, TIMESTAMP '9999-12-31')", base=False)(
    lambda spark, sf_dir: H.interval_join_spread(hot_events(spark, sf_dir), user_history(spark, sf_dir), ["user_id"], "ts", how="left").select("event_id", "kind")
)
add("j9_hot_chained", HOT + "SELECT event_id, h.kind, g.kind AS manager_kind FROM f JOIN h ON f.user_id = h.user_id AND ts >= h.effective AND ts < coalesce(h.expiration, TIMESTAMP '9999-12-31') JOIN h g ON g.user_id = length(h.kind) AND ts >= g.effective AND ts < coalesce(g.expiration, TIMESTAMP '9999-12-31')", base=False)(
    lambda spark, sf_dir: (
        lambda h: H.interval_join_spread(
            written(H.interval_join_spread(hot_events(spark, sf_dir), h, ["user_id"], "ts").select("event_id", "ts", "kind", F.length("kind").cast("long").alias("manager")), "chained"),
            h.select(F.col("user_id").alias("manager"), F.col("kind").alias("manager_kind"), "effective", "expiration"), ["manager"], "ts",
        ).select("event_id", "kind", "manager_kind")
    )(written(user_history(spark, sf_dir), "user-history"))
)

# Two versions of every third customer, part, supplier and nation; some keys are not in the history, some versions overlap.
VERSIONS = {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey", "nation": "n_nationkey"}
VERSIONED = "WITH " + ", ".join(f"""{n}_h AS (SELECT {k} AS id, {k} * 10 + v AS sk, CASE WHEN v = 0 THEN TIMESTAMP '1900-01-01' ELSE TIMESTAMP '1995-06-17' END AS effective,
  CASE WHEN v = 0 AND {k} % 3 = 0 AND {k} % 33 <> 0 THEN TIMESTAMP '1995-06-17' END AS expiration{", s_nationkey AS zip" if n == "supplier" else ""} FROM {n}, (SELECT unnest([0, 1]) AS v) WHERE (v = 0 OR {k} % 3 = 0) AND {k} % 50 <> 49)""" for n, k in VERSIONS.items()) + """,
f AS (SELECT l_orderkey, l_linenumber, o_custkey AS customer, l_partkey AS product, l_suppkey AS seller, c_nationkey AS zip, o_orderstatus AS status, o_orderdate AS bought FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
r AS (SELECT f.*, c.sk AS customer_sk, p.sk AS product_sk, s.sk AS seller_sk, g.sk AS customer_zip_sk, z.sk AS seller_zip_sk, st.sk AS status_sk FROM f
  LEFT JOIN customer_h c ON c.id = customer AND bought >= c.effective AND bought < coalesce(c.expiration, TIMESTAMP '9999-12-31') LEFT JOIN part_h p ON p.id = product AND bought >= p.effective AND bought < coalesce(p.expiration, TIMESTAMP '9999-12-31')
  LEFT JOIN supplier_h s ON s.id = seller AND bought >= s.effective AND bought < coalesce(s.expiration, TIMESTAMP '9999-12-31') LEFT JOIN nation_h g ON g.id = f.zip AND bought >= g.effective AND bought < coalesce(g.expiration, TIMESTAMP '9999-12-31')
  LEFT JOIN nation_h z ON z.id = s.zip AND bought >= z.effective AND bought < coalesce(z.expiration, TIMESTAMP '9999-12-31') LEFT JOIN (SELECT * FROM (VALUES ('F', 1), ('O', 2)) x(status, sk)) st ON st.status = f.status)
"""


def six_roles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    def history(name: str, key: str, *more: str) -> DataFrame:
        rows = table(spark, sf_dir, name).select(F.col(key).alias("id"), *more, F.explode(F.array(F.lit(0), F.lit(1))).alias("v")).filter("(v = 0 OR id % 3 = 0) AND id % 50 <> 49")
        ends = F.expr("CASE WHEN v = 0 AND id % 3 = 0 AND id % 33 <> 0 THEN TIMESTAMP '1995-06-17' END")
        return rows.withColumn("sk", F.col("id") * 10 + F.col("v")).withColumn("effective", F.expr("CASE WHEN v = 0 THEN TIMESTAMP '1900-01-01' ELSE TIMESTAMP '1995-06-17' END")).withColumn("expiration", ends)

    dimensions = {n: history(n, k, *(["s_nationkey"] if n == "supplier" else [])) for n, k in VERSIONS.items()} | {"status": spark.createDataFrame([("F", 1), ("O", 2)], "status string, sk int")}
    fact = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    fact = fact.selectExpr("l_orderkey", "l_linenumber", "o_custkey AS customer", "l_partkey AS product", "l_suppkey AS seller", "c_nationkey AS zip", "o_orderstatus AS status", "o_orderdate AS bought")
    roles = [
        H.Role("customer_sk", "customer", {"customer": "id"}, "sk"), H.Role("product_sk", "part", {"product": "id"}, "sk"), H.Role("seller_sk", "supplier", {"seller": "id"}, "sk", {"s_nationkey": "seller_zip"}),
        H.Role("customer_zip_sk", "nation", {"zip": "id"}, "sk"), H.Role("seller_zip_sk", "nation", {"seller_zip": "id"}, "sk"), H.Role("status_sk", "status", {"status": "status"}, "sk", timed=False),
    ]
    return H.resolve_roles(fact, dimensions, roles, ["l_orderkey", "l_linenumber"], "bought")


add("h4_six_roles", VERSIONED + "SELECT l_orderkey, l_linenumber, customer_sk, product_sk, seller_sk, customer_zip_sk, seller_zip_sk, status_sk FROM r", base=False)(
    lambda spark, sf_dir: six_roles(spark, sf_dir)[0].select("l_orderkey", "l_linenumber", "customer_sk", "product_sk", "seller_sk", "customer_zip_sk", "seller_zip_sk", "status_sk")
)
SIX = ["customer_sk", "product_sk", "seller_sk", "customer_zip_sk", "seller_zip_sk", "status_sk"]
add("h4_roles_proof", VERSIONED + f""", q AS (SELECT l_orderkey, l_linenumber, count(*) AS n_rows, concat_ws(',', {", ".join(f"CASE WHEN count({c}) < count(*) THEN '{c}' END" for c in SIX)}) AS missing,
  concat_ws(',', {", ".join(f"CASE WHEN min({c}) <> max({c}) THEN '{c}' END" for c in SIX)}) AS ambiguous FROM r GROUP BY 1, 2) SELECT * FROM q WHERE n_rows <> 1 OR missing <> '' OR ambiguous <> ''""", base=False)(
    lambda spark, sf_dir: six_roles(spark, sf_dir)[1].select("l_orderkey", "l_linenumber", "n_rows", F.concat_ws(",", "missing").alias("missing"), F.concat_ws(",", "ambiguous").alias("ambiguous"))
)


@add("h1_touched_buckets", WEEKS + HISTORY, base=False)
def h1_touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All weeks but three at once, those a batch each into the stored history, of which only buckets with a new version are rewritten."""
    rows, root = written(weeks(spark, sf_dir), "weeks"), new_path(spark, "history")
    starts = [r[0] for r in rows.select("week").distinct().orderBy(F.desc("week")).limit(3).collect()]
    history_store.create_history(H.scd2_backfill(rows.filter(F.col("week") < starts[-1]), ["user_id"], "week", "hash"), root, ["user_id"], 32)
    for start in reversed(starts):
        history_store.apply_batch(rows.filter(F.col("week") == start), root, "hash", "week")
    return history_store.read_history(spark, root).select("user_id", "kind", "effective", "expiration", "is_current")


add("j11_overlaps", WEEKS + "SELECT user_id, effective FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY effective) AS n FROM h) WHERE n > 1", base=False)(lambda spark, sf_dir: H.overlaps(user_history(spark, sf_dir).withColumn("expiration", F.lit(None).cast("timestamp")), ["user_id"]).select("user_id", "effective"))
add("j10_absent_from", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > c_acctbal * 30)", base=False)(
    lambda spark, sf_dir: H.absent_from(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_totalprice") > F.col("c_acctbal") * 30)).select("c_custkey")
)

# Publication.
add("s10_batch_summary", "SELECT 'orders' AS dataset, (SELECT count(*) FROM orders) AS source, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS processed UNION ALL SELECT 'customers', (SELECT count(*) FROM customer), 0", base=False)(
    lambda spark, sf_dir: P.batch_summary({"source": {"orders": table(spark, sf_dir, "orders"), "customers": table(spark, sf_dir, "customer")}, "processed": {"orders": table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")}})
)
add("s11_verify_summary", "SELECT 'orders' AS dataset, count(*) + 1 AS declared, count(*) AS counted FROM orders UNION ALL SELECT 'nation', NULL, count(*) FROM nation", base=False)(
    lambda spark, sf_dir: P.verify_summary(
        P.counts_of({"orders": table(spark, sf_dir, "orders"), "region": table(spark, sf_dir, "region")}).withColumn("n_rows", F.col("n_rows") + (F.col("dataset") == "orders").cast("long")),
        {"orders": table(spark, sf_dir, "orders"), "region": table(spark, sf_dir, "region"), "nation": table(spark, sf_dir, "nation")},
    )
)
# A summary for each region: the batch of one is another's, the version of one is old, one dataset is no one's, one is missing.
add("s11_verify_identity", """SELECT dataset, field, declared FROM (SELECT r_name AS dataset, 'batch_id' AS field, CASE WHEN r_regionkey = 1 THEN 'b2' END AS declared FROM region UNION ALL SELECT r_name, 'contract_version', CASE WHEN r_regionkey = 2 THEN '0' END FROM region) WHERE declared IS NOT NULL
  UNION ALL SELECT r_name, 'dataset', 'unexpected' FROM region WHERE r_regionkey = 4 UNION ALL SELECT 'NOWHERE', 'dataset', 'missing' FROM region WHERE r_regionkey = 0""", base=False)(  # fmt: skip
    lambda spark, sf_dir: (
        lambda r: P.verify_identity(
            r.selectExpr("r_name AS dataset", "IF(r_regionkey = 1, 'b2', 'b1') AS batch_id", "IF(r_regionkey = 2, 0, 1) AS contract_version"),
            [x[0] for x in r.filter("r_regionkey <> 4").select("r_name").collect()] + ["NOWHERE"], {"batch_id": "b1", "contract_version": 1},
        )
    )(table(spark, sf_dir, "region"))
)
add("h5_sync_static", "SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 OR c_acctbal >= 5000 THEN c_mktsegment ELSE 'old' END AS v, CASE WHEN c_acctbal < 5000 THEN c_custkey + 1 ELSE 1000000 + row_number() OVER (PARTITION BY c_acctbal >= 5000 ORDER BY c_custkey) END AS sk FROM customer", base=False)(
    lambda spark, sf_dir: (
        lambda c: P.sync_static(
            c.filter("c_acctbal < 5000").selectExpr("c_custkey AS k", "'old' AS v", "c_custkey + 1 AS sk").unionByName(spark.range(1).selectExpr("-1L AS k", "'old' AS v", "1000000L AS sk")),
            c.filter("c_custkey % 2 = 0 OR c_acctbal >= 5000").selectExpr("c_custkey AS k", "c_mktsegment AS v"), "k", "sk",
        ).filter("k >= 0")
    )(table(spark, sf_dir, "customer"))
)
add("h6_publish_snapshot", "SELECT c_custkey AS k, c_name AS v, CASE WHEN c_acctbal < 5000 THEN c_custkey + 1 ELSE (SELECT max(c_custkey) + 1 FROM customer WHERE c_acctbal < 5000) + row_number() OVER (PARTITION BY c_acctbal >= 5000 ORDER BY c_custkey) END AS sk FROM customer WHERE c_nationkey > 3", base=False)(
    lambda spark, sf_dir: (lambda c: P.publish_snapshot(c.filter("c_acctbal < 5000").selectExpr("c_custkey AS k", "c_custkey + 1 AS sk"), c.filter("c_nationkey > 3").selectExpr("c_custkey AS k", "c_name AS v"), "k", "sk"))(table(spark, sf_dir, "customer"))
)
add("h7_publication_decision", """SELECT CAST(user_id AS VARCHAR) AS batch_id, CASE WHEN user_id % 4 = 0 THEN 'PUBLISH' WHEN user_id % 4 = 1 THEN 'NO_OP' WHEN user_id % 4 = 2 THEN 'CONFLICT' ELSE 'ERROR' END AS decision FROM (SELECT DISTINCT user_id FROM events)""", base=False)(
    lambda spark, sf_dir: (
        lambda u: P.publication_decision(
            u.filter("user_id % 4 <> 0").selectExpr("CAST(user_id AS STRING) AS batch_id", "CASE WHEN user_id % 4 = 2 THEN 'other' ELSE 'same' END AS fingerprint").unionByName(u.filter("user_id % 4 = 3").selectExpr("CAST(user_id AS STRING) AS batch_id", "'same' AS fingerprint")),
            u.selectExpr("CAST(user_id AS STRING) AS batch_id", "'same' AS fingerprint"),
        )
    )(table(spark, sf_dir, "events").select("user_id").distinct())
)
REQUESTS = "WITH q AS (SELECT CAST(c_custkey AS VARCHAR) AS batch_id, c_mktsegment AS fingerprint, c_custkey AS k FROM customer)"


def publication_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("CAST(c_custkey AS STRING) AS batch_id", "c_mktsegment AS fingerprint")


def registered(requests: DataFrame) -> DataFrame:
    """Of the requests all but each fifth, each third with another fingerprint, each tenth less one twice."""
    k = F.col("batch_id").cast("int")
    rows = requests.filter(k % 5 != 0).withColumn("fingerprint", F.when(k % 3 == 0, "other").otherwise(F.col("fingerprint")))
    return rows.unionByName(rows.filter(k % 10 == 9))


add("h8_registry_rows", REQUESTS + "SELECT batch_id, fingerprint, TIMESTAMP '2018-04-01' AS published_at FROM q WHERE k % 5 = 0", base=False)(
    lambda spark, sf_dir: (lambda q: P.registry_rows(q, P.publication_decision(registered(q), q), D.BATCH))(publication_requests(spark, sf_dir))
)
add("h8_current_snapshot", "SELECT CAST(o_orderkey AS VARCHAR) AS batch_id, o_orderstatus AS fingerprint, o_orderdate AS published_at FROM orders ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC LIMIT 1", base=False)(
    lambda spark, sf_dir: P.current_snapshot(table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey AS STRING) AS batch_id", "o_orderstatus AS fingerprint", "o_orderdate AS published_at"))
)
add("h9_verify_registry", REQUESTS + "SELECT batch_id, CASE WHEN k % 5 = 0 THEN 'unregistered' WHEN k % 10 = 9 THEN 'registered_twice' ELSE 'other_fingerprint' END AS issue FROM q WHERE k % 5 = 0 OR k % 10 = 9 OR k % 3 = 0", base=False)(
    lambda spark, sf_dir: (lambda q: P.verify_registry(registered(q), q))(publication_requests(spark, sf_dir))
)
add("h9_verify_publication", """SELECT 'batch-1' AS subject, 'other_fingerprint' AS issue FROM region WHERE r_regionkey = 0 UNION ALL SELECT 'customer', CAST(2 * count(*) AS VARCHAR) || ' rows differ' FROM customer WHERE c_custkey % 7 = 0""", base=False)(
    lambda spark, sf_dir: (
        lambda c, n, one: P.verify_publication(
            one.selectExpr("'batch-1' AS batch_id", "'old' AS fingerprint"), one.selectExpr("'batch-1' AS batch_id", "'new' AS fingerprint"), {"customer": c, "nation": n},
            {"customer": c.withColumn("c_name", F.when(F.col("c_custkey") % 7 == 0, "changed").otherwise(F.col("c_name"))), "nation": n},
        )
    )(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), table(spark, sf_dir, "nation"), table(spark, sf_dir, "region").filter("r_regionkey = 0"))
)
on_star("h10_verify_representative", 'SELECT DISTINCT "OrderID", \'wrong\' AS "PaymentType", pay1.type AS expected FROM f LEFT JOIN pay1 ON order_id = "OrderID" WHERE "OrderID" % 100 = 5',
        lambda t: P.verify_representative(t["fact_sales"].withColumn("PaymentType", F.when(F.col("OrderID") % 100 == 5, "wrong").otherwise(F.col("PaymentType"))), t["order_payments"]))


@add("h11_verify_marts", """SELECT 'monthly_sales' AS dataset, 2 * count(DISTINCT month("OrderPurchaseTimestamp")) AS differing_rows FROM f WHERE year("OrderPurchaseTimestamp") = 1996
  UNION ALL SELECT 'seller_performance', count(DISTINCT "SellerID") FROM f WHERE "SellerID" % 10 = 3""")  # fmt: skip
def h11_verify_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight marts as published, with a year's orders changed in one and a tenth of the sellers lost from another."""
    rich, sales = for_marts(D.star(spark, sf_dir))
    published = M.all_marts(rich, sales)
    published["monthly_sales"] = published["monthly_sales"].withColumn("OrdersCount", F.col("OrdersCount") + (F.col("Year") == 1996).cast("int"))
    published["seller_performance"] = published["seller_performance"].filter("SellerID % 10 <> 3")
    return P.verify_marts(rich, sales, published)


on_star("h12_stage_completeness", """SELECT 'missing' AS issue, 'reviews' AS dataset WHERE NOT EXISTS (SELECT 1 FROM f WHERE "OrderID" < 0) UNION ALL SELECT DISTINCT 'foreign_identity', 'sales' FROM f WHERE "OrderID" % 10 = 0
  UNION ALL SELECT DISTINCT 'duplicate_ordinal', 'sales' FROM (SELECT "OrderID" FROM f WHERE "OrderID" % 10 <> 0 GROUP BY 1 HAVING count(*) > 1)""",
        lambda t: P.stage_completeness(t["fact_sales"].selectExpr("'sales' AS dataset", "CASE WHEN OrderID % 10 = 0 THEN 'a0' ELSE 'a1' END AS attempt_id", "'b1' AS batch_id", "OrderID AS ordinal"), ["sales", "reviews"], "a1", "b1"))

# Replay: events as the audit of a day's submissions by type (dataset) and user (batch).
AUDIT = """
WITH a AS (
  SELECT event_type AS dataset, CAST(user_id AS VARCHAR) AS batch_id, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS attempt_number, 's' || event_id AS submission_id, ts AS submitted_at,
         '2024' AS batch_timestamp, 'f' || user_id AS source_file_id, sha256(event_type || CAST(user_id AS VARCHAR)) AS content_sha256,
         CASE WHEN value < 10 THEN 'FAILED' ELSE 'SUCCEEDED' END AS terminal_status, event_id % 2 = 0 AS retryable
  FROM events),
last AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY dataset, batch_id ORDER BY attempt_number DESC) = 1)
"""


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = S.Window.partitionBy("event_type", "user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").withColumn("attempt_number", F.row_number().over(w)).selectExpr(
        "event_type AS dataset", "CAST(user_id AS STRING) AS batch_id", "attempt_number", "concat('s', event_id) AS submission_id", "ts AS submitted_at", "'2024' AS batch_timestamp", "concat('f', user_id) AS source_file_id",
        "sha2(concat(event_type, user_id), 256) AS content_sha256", "CASE WHEN value < 10 THEN 'FAILED' ELSE 'SUCCEEDED' END AS terminal_status", "event_id % 2 = 0 AS retryable", "'new-content' AS replay_outcome", "CAST(NULL AS STRING) AS reused_submission_id",
    )


def manifests(a: DataFrame) -> DataFrame:
    """Per dataset and batch one manifest: as before, with another file for users divisible by 7, and a batch never seen."""
    known = a.select("dataset", "batch_id", "batch_timestamp", "source_file_id", "content_sha256").distinct()
    moved = known.withColumn("source_file_id", F.when(F.col("batch_id").cast("int") % 7 == 0, "other").otherwise(F.col("source_file_id")))
    return moved.unionByName(known.withColumn("batch_id", F.concat(F.lit("new-"), "batch_id")))


add("w5_latest_attempt", AUDIT + "SELECT dataset, batch_id, attempt_number, submission_id FROM last", base=False)(lambda spark, sf_dir: R.latest_attempt(audit(spark, sf_dir)).select("dataset", "batch_id", "attempt_number", "submission_id"))
add("w6_latest_match", AUDIT + "SELECT dataset, content_sha256, arg_max(submission_id, (submitted_at, submission_id)) AS submission_id FROM a WHERE terminal_status = 'SUCCEEDED' GROUP BY 1, 2", base=False)(lambda spark, sf_dir: R.latest_match(audit(spark, sf_dir)))
DECISIONS = AUDIT + """, m AS (SELECT DISTINCT dataset, batch_id, CAST(batch_id AS INT) % 7 = 0 AS moved FROM a),
match AS (SELECT dataset, content_sha256, arg_max(submission_id, (submitted_at, submission_id)) AS id FROM a WHERE terminal_status = 'SUCCEEDED' GROUP BY 1, 2),
seen AS (SELECT dataset, max(terminal_status) = 'SUCCEEDED' AS loaded FROM a GROUP BY 1),
d AS (
  SELECT m.dataset, m.batch_id, CASE WHEN moved THEN 'fail-batch' WHEN l.terminal_status = 'SUCCEEDED' THEN 'no-op' WHEN l.retryable THEN 'retry' ELSE 'reused-failure' END AS decision, l.submission_id AS sid
  FROM m JOIN last l USING (dataset, batch_id)
  UNION ALL
  SELECT l.dataset, 'new-' || l.batch_id, CASE WHEN match.id IS NOT NULL THEN 'no-op' WHEN loaded THEN 'new-content' ELSE 'initial-load' END, match.id
  FROM last l LEFT JOIN match ON match.dataset = l.dataset AND match.content_sha256 = l.content_sha256 JOIN seen ON seen.dataset = l.dataset)
"""


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audit(spark, sf_dir)
    return R.replay_decisions(manifests(a), a)


add("r1_replay_decisions", DECISIONS + "SELECT dataset, batch_id, decision, CASE WHEN decision IN ('no-op', 'reused-failure') THEN sid END AS reused_submission_id FROM d", base=False)(lambda spark, sf_dir: decisions(spark, sf_dir).select("dataset", "batch_id", "decision", "reused_submission_id"))
add("r2_late_decisions", DECISIONS + "SELECT dataset, batch_id, CASE WHEN decision = 'new-content' AND CAST(substr(batch_id, 5) AS INT) % 2 = 0 THEN 'late-content' ELSE decision END AS decision FROM d", base=False)(
    lambda spark, sf_dir: (
        lambda a: R.replay_decisions(
            manifests(a).withColumn("max_event_timestamp", F.when(F.regexp_extract("batch_id", r"(\d+)$", 1).cast("int") % 2 == 0, F.lit("2000-01-01").cast("timestamp")).otherwise(F.lit("2100-01-01").cast("timestamp"))),
            a.withColumn("max_event_timestamp", F.col("submitted_at")),
        ).select("dataset", "batch_id", "decision")
    )(audit(spark, sf_dir))
)
add("r3_abort_batch", DECISIONS + ", b AS (SELECT batch_id FROM d WHERE decision = 'fail-batch' GROUP BY 1) SELECT dataset, batch_id, CASE WHEN batch_id IN (SELECT batch_id FROM b) AND decision NOT IN ('no-op', 'reused-failure') THEN 'fail-batch' ELSE decision END AS decision FROM d", base=False)(lambda spark, sf_dir: R.abort_batch(decisions(spark, sf_dir)).select("dataset", "batch_id", "decision"))
add("r6_audit_records", DECISIONS + "SELECT decision, CASE decision WHEN 'no-op' THEN 'SKIPPED' WHEN 'reused-failure' THEN 'FAILED' WHEN 'fail-batch' THEN 'FAILED' ELSE 'SUCCEEDED' END AS terminal_status, count(*) AS n FROM d GROUP BY 1, 2", base=False)(lambda spark, sf_dir: R.audit_records(decisions(spark, sf_dir)).groupBy("decision", "terminal_status").agg(F.count("*").alias("n")))
add("r5_next_attempt", AUDIT + "SELECT dataset, batch_id, attempt_number + 1 AS next_attempt FROM last UNION ALL SELECT dataset, 'new-' || batch_id, 1 FROM last", base=False)(lambda spark, sf_dir: (lambda a: R.next_attempt(manifests(a), a).select("dataset", "batch_id", "next_attempt"))(audit(spark, sf_dir)))
add("r2_late_content", "SELECT event_type AS dataset, user_id AS batch_id, max(ts) AS max_event_timestamp, max(ts) < (SELECT max(ts) FROM events h WHERE h.event_type = e.event_type AND h.user_id % 2 = 0) AS is_late FROM events e WHERE user_id % 2 = 1 GROUP BY 1, 2", base=False)(
    lambda spark, sf_dir: (lambda b: R.late_content(b.filter("batch_id % 2 = 1"), b.filter("batch_id % 2 = 0")))(table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("dataset"), F.col("user_id").alias("batch_id")).agg(F.max("ts").alias("max_event_timestamp")))
)
add("r4_batch_timestamp_conflicts", "SELECT user_id AS batch_id, count(DISTINCT CAST(ts AS DATE)) AS n_timestamps FROM events GROUP BY 1 HAVING count(DISTINCT CAST(ts AS DATE)) > 1", base=False)(lambda spark, sf_dir: R.batch_timestamp_conflicts(table(spark, sf_dir, "events").select(F.col("user_id").alias("batch_id"), F.to_date("ts").alias("batch_timestamp"))))
add("r4_manifest_set_check", "SELECT b AS batch_id, t AS missing FROM (SELECT DISTINCT event_id % 1000 AS b FROM events), (SELECT unnest(['click', 'view', 'purchase', 'error', 'signup']) AS t) WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_id % 1000 = b AND event_type = t)", base=False)(
    lambda spark, sf_dir: R.manifest_set_check(table(spark, sf_dir, "events").selectExpr("event_id % 1000 AS batch_id", "event_type AS dataset"), ["click", "view", "purchase", "error", "signup"])
)
add("r7_audit_violations", AUDIT + "SELECT dataset, batch_id, attempt_number, 'duplicate_attempt' AS issue FROM a WHERE attempt_number = 1 UNION ALL SELECT dataset, batch_id, 1, 'duplicate_attempt' FROM a WHERE attempt_number = 2", base=False)(
    lambda spark, sf_dir: R.audit_violations(audit(spark, sf_dir).withColumn("attempt_number", F.when(F.col("attempt_number") == 2, 1).otherwise(F.col("attempt_number")))).filter("issue = 'duplicate_attempt'")
)
SQL["r7_audit_violations"] = AUDIT + "SELECT dataset, batch_id, 1 AS attempt_number, 'duplicate_attempt' AS issue FROM a WHERE attempt_number <= 2 QUALIFY count(*) OVER (PARTITION BY dataset, batch_id) > 1"

# Single rules, loads, unions and stamps.
add("q2_required_key_null", "SELECT event_id FROM events WHERE event_id % 6 = 0 OR user_id % 9 = 0", base=False)(
    lambda spark, sf_dir: Q.reject_rows(table(spark, sf_dir, "events").selectExpr("event_id", "nullif(event_id % 6, 0) AS a", "nullif(user_id % 9, 0) AS b"), [Q.required(["a", "b"])])[1].select("event_id")
)


@add("q3_invalid_parse", "SELECT event_id FROM events WHERE event_id % 10 = 0 OR event_id % 7 = 0", base=False)
def q3_invalid_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymart.contracts import contract

    text = table(spark, sf_dir, "events").selectExpr("CAST(event_id AS STRING) AS event_id", "CASE WHEN event_id % 10 = 0 THEN 'x' ELSE CAST(value AS STRING) END AS v", "CASE WHEN event_id % 7 <> 0 THEN event_type END AS kind")
    c = contract("events", "event_id integer, v decimal(12,2)?, kind string", "event_id")
    return Q.reject_rows(parsing.normalize(text, c), [Q.unparsed(c)])[1].select("event_id")


add("q4_invalid_monetary_value", "SELECT c_custkey FROM customer WHERE c_acctbal - 3000 < 0 OR c_nationkey < 2", base=False)(
    lambda spark, sf_dir: Q.reject_rows(table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_acctbal - 3000 AS amount", "c_nationkey"), [Q.not_negative(["amount"], {"c_nationkey": 2})])[1].select("c_custkey")
)
add("q5_invalid_review_score", "SELECT event_id AS review_id FROM events WHERE event_type = 'view' AND event_id % 7 >= 5", base=False)(lambda spark, sf_dir: Q.reject_rows(D.frames(spark, sf_dir)["order_reviews"], [Q.score_between("review_score")])[1].select("review_id"))
add("q7_invalid_range", "SELECT p_partkey FROM part WHERE p_size < 3 OR p_size > 45 OR p_retailprice > 1500", base=False)(lambda spark, sf_dir: Q.reject_rows(table(spark, sf_dir, "part"), [Q.in_range({"p_size": (3, 45), "p_retailprice": (None, 1500)})])[1].select("p_partkey"))


@add("q19_content_violations", "SELECT c_custkey FROM customer WHERE c_custkey % 10 = 3 OR c_custkey % 10 = 4", base=False)
def q19_content_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymart.contracts import contract

    rows = I.with_record_hash(table(spark, sf_dir, "customer").select("c_custkey", "c_name")).withColumns({"c_name": F.when(F.col("c_custkey") % 10 != 3, F.col("c_name")), "RecordHash": F.when(F.col("c_custkey") % 10 == 4, F.upper("RecordHash")).otherwise(F.col("RecordHash"))})
    return Q.content_violations(rows, contract("c", "c_custkey integer, c_name string")).select("c_custkey")


@add("s15_stage_for_history", """SELECT c_custkey, c_mktsegment, sha256('{"c_mktsegment":"' || c_mktsegment || '"}') AS "TrackedHash", 'a1' AS "AttemptID", 'b1' AS "BatchID", TIMESTAMP '2018-04-01' AS "EffectiveAt" FROM customer""", base=False)
def s15_stage_for_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymart.contracts import contract
    from tallymart.sources.sinks import stage_for_history

    return stage_for_history(table(spark, sf_dir, "customer"), contract("c", "c_custkey integer, c_mktsegment string", tracked="c_mktsegment"), "a1", "b1", D.BATCH)


PEOPLE = "c_custkey integer, c_name string, c_mktsegment string, balance decimal(12,2)"


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name", "CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS c_mktsegment", "CAST(c_acctbal AS DECIMAL(12,2)) AS balance")


def exported(spark: SparkSession, sf_dir: str) -> str:
    """The customers as a CSV export in a fresh folder."""
    path = new_path(spark, "export")
    sinks.write_csv_export(people(spark, sf_dir), path)
    return path


PEOPLE_SQL = "CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS c_mktsegment"


@add("s1_read_contract_csv", f"SELECT c_custkey, c_name, {PEOPLE_SQL}, CAST(c_acctbal AS DECIMAL(12,2)) AS balance FROM customer", base=False)
def s1_read_contract_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymart.contracts import contract

    c = contract("people", PEOPLE.replace("c_mktsegment string", "c_mktsegment string?"))
    return parsing.project_contract(parsing.normalize(files.read_contract_csv(spark, exported(spark, sf_dir), c), c), c)


add("s2_read_inferred_csv", f"SELECT c_custkey, c_name, {PEOPLE_SQL}, CAST(c_acctbal AS DOUBLE) AS balance FROM customer", base=False)(lambda spark, sf_dir: files.read_inferred_csv(spark, exported(spark, sf_dir)).withColumn("c_custkey", F.col("c_custkey").cast("long")))
add("s8_write_csv_export", f"SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, {PEOPLE_SQL}, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS balance FROM customer", base=False)(lambda spark, sf_dir: spark.read.option("header", True).csv(exported(spark, sf_dir)))


@add("s7_write_layer", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders", base=False)
def s7_write_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice: the second write stands in place of the first."""
    path, rows = new_path(spark, "layer"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    sinks.write_layer(rows.filter("o_orderkey % 2 = 0"), path)
    sinks.write_layer(rows, path)
    return files.read_layer(spark, path)


@add("s9_publish_batch", "SELECT 'b' || b AS batch_id, 'customers' AS dataset, (SELECT count(*) FROM customer WHERE c_custkey % 2 = b) AS n_rows FROM (SELECT unnest([0, 1]) AS b) UNION ALL SELECT 'b' || b, 'orders', (SELECT count(*) FROM orders WHERE o_orderkey % 2 = b) FROM (SELECT unnest([0, 1]) AS b)", base=False)
def s9_publish_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the first published twice: the markers that stand in the end."""
    root = new_path(spark, "published")
    for b in (0, 1, 0):
        sinks.publish_batch({"customers": table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 2 == b), "orders": table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 2 == b)}, root, f"b{b}")
    return publication.published(spark, root).select("batch_id", "dataset", "n_rows")


@add("s9_after_failure", "SELECT 'b1' AS batch_id, o_orderkey AS key, o_orderstatus AS status, 'orders' AS dataset FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'b1', c_custkey, 'old', 'customers' FROM customer UNION ALL SELECT 'b2', c_custkey, 'new', 'customers' FROM customer WHERE c_custkey % 3 = 0", base=False)
def s9_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch is published; publishing it again fails in the second table; another batch with an empty table is published. What readers see then."""
    root = new_path(spark, "published")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    publication.publish({"orders": orders.filter("key % 2 = 0"), "customers": people.withColumn("status", F.lit("old"))}, root, "b1", D.BATCH)
    broken = people.withColumn("status", F.when(F.col("key") > 100, F.raise_error(F.lit("provoked"))).otherwise(F.lit("new")))
    try:
        publication.publish({"orders": orders, "customers": broken}, root, "b1", D.BATCH)
    except Exception as e:
        if "provoked" not in str(e):
            raise
    else:
        raise AssertionError("a publication with a failing table has ended")
    publication.publish({"orders": orders.limit(0), "customers": people.filter("key % 3 = 0").withColumn("status", F.lit("new"))}, root, "b2", D.BATCH)
    parts = [publication.read_published(spark, root, n).select("batch_id", "key", "status", F.lit(n).alias("dataset")) for n in ("orders", "customers")]
    return parts[0].unionByName(parts[1])


REGISTERED = """
  SELECT 'registry' AS kind, 'b1' AS batch_id, 'f1' AS what, 1 AS n UNION ALL SELECT 'registry', 'b2', 'f3', 1
  UNION ALL SELECT 'event', 'b1', 'STARTED', 1 UNION ALL SELECT 'event', 'b1', 'COMPLETED', 1 UNION ALL SELECT 'event', 'b1', 'NO_OP', 1 UNION ALL SELECT 'event', 'b1', 'CONFLICT', 1
  UNION ALL SELECT 'event', 'b2', 'STARTED', 1 UNION ALL SELECT 'event', 'b2', 'COMPLETED', 1
  UNION ALL SELECT 'rows', 'b1', 'orders', CAST(count(*) AS INT) FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'rows', 'b2', 'orders', CAST(count(*) AS INT) FROM orders WHERE o_orderstatus <> 'F'
  UNION ALL SELECT 'current', 'b2', 'f3', 1"""


@add("h8_publish_once", REGISTERED, base=False)
def h8_publish_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the first asked for three times: registry, events, current snapshot and rows as they are read back."""
    root = new_path(spark, "registered")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    done, rest = {"orders": orders.filter("o_orderstatus = 'F'")}, {"orders": orders.filter("o_orderstatus <> 'F'")}
    for frames, batch, print_, at, attempt in ((done, "b1", "f1", D.BATCH, "a1"), (done, "b1", "f1", D.BATCH, "a2"), (rest, "b1", "f2", D.BATCH, "a3"), (rest, "b2", "f3", "2018-04-02 00:00:00", "a4")):
        publication.publish_once(frames, root, batch, print_, at, attempt)
    known = publication.registry(spark, root)
    parts = [
        known.select(F.lit("registry").alias("kind"), "batch_id", F.col("fingerprint").alias("what"), F.lit(1).alias("n")),
        publication.events(spark, root).groupBy("batch_id", "event").agg(F.count("*").cast("int").alias("n")).select(F.lit("event").alias("kind"), "batch_id", F.col("event").alias("what"), "n"),
        publication.read_published(spark, root, "orders").groupBy("batch_id").agg(F.count("*").cast("int").alias("n")).select(F.lit("rows").alias("kind"), "batch_id", F.lit("orders").alias("what"), "n"),
        P.current_snapshot(known).select(F.lit("current").alias("kind"), "batch_id", F.col("fingerprint").alias("what"), F.lit(1).alias("n")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@add("s10_counts_while_writing", "SELECT 'customers' AS dataset, count(*) AS n_rows, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS VARCHAR) AS total FROM customer UNION ALL SELECT 'orders', count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS VARCHAR) FROM orders", base=False)
def s10_counts_while_writing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and totals of a publication as its summary has them, taken by the tasks that wrote."""
    root = new_path(spark, "published")
    money = lambda name, c: table(spark, sf_dir, name).select(F.col(c).cast("decimal(12,2)").alias("money"))
    publication.publish({"customers": money("customer", "c_acctbal"), "orders": money("orders", "o_totalprice")}, root, "b1", D.BATCH, totals={"customers": ["money"], "orders": ["money"]})
    return publication.published(spark, root).select("dataset", "n_rows", F.col("totals")["money"].alias("total"))


@add("s14_partitioned_table", "SELECT 'b' || o_orderkey % 3 AS batch_id, o_orderkey FROM orders WHERE o_orderkey % 3 = 1 AND o_orderstatus = 'F'", base=False)
def s14_partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches as partitions of a catalog table, one published again after it was registered; a query on that one."""
    path = new_path(spark, "catalogued")
    orders, name = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path.rpartition("/")[2].replace("-", "_")
    for b in (0, 1):
        publication.publish({"orders": orders.filter(F.col("o_orderkey") % 3 == b)}, path, f"b{b}", D.BATCH)
    publication.register_published(spark, path, "orders", name)
    publication.publish({"orders": orders.filter("o_orderkey % 3 = 1 AND o_orderstatus = 'F'")}, path, "b1", D.BATCH)
    publication.publish({"orders": orders.filter("o_orderkey % 3 = 2")}, path, "b2", D.BATCH)
    publication.register_published(spark, path, "orders", name)
    return spark.table(name).filter("batch_id = 'b1'").select("batch_id", "o_orderkey")


add("s12_source_inventory")(lambda spark, sf_dir: files.source_inventory(spark, sf_dir, ["region.parquet", "Nation.parquet", "absent.parquet"]))


@add("s13_known_contents", "SELECT CAST(strlen(n_name) + 1 AS BIGINT) AS n_bytes, sha256(n_name || chr(10)) AS content_sha256 FROM nation UNION ALL SELECT CAST(sum(strlen(r_name) + 1) AS BIGINT), sha256(string_agg(r_name || chr(10), '' ORDER BY r_regionkey)) FROM region", base=False)
def s13_known_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of files with known contents: one for each nation, small enough to be a value, and one for the regions, read in blocks."""
    root = new_path(spark, "contents")
    table(spark, sf_dir, "nation").selectExpr("n_name AS value", "n_nationkey AS n").repartition(1).write.partitionBy("n").text(f"{root}/nations")
    table(spark, sf_dir, "region").orderBy("r_regionkey").select("r_name").coalesce(1).write.text(f"{root}/regions")
    nations = files.file_manifests(spark, f"{root}/nations", "b1", D.BATCH, "*.txt").select("n_bytes", "content_sha256")
    return nations.unionByName(files.file_digests(spark, f"{root}/regions", "*.txt", whole=0).select(F.col("length").alias("n_bytes"), F.col("digest").alias("content_sha256")))


@add("s6_append_jdbc", "SELECT o_orderkey AS \"KEY_ID\", o_orderstatus AS \"STATUS\", CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS \"ATTEMPT_ID\" FROM orders", base=False)
def s6_append_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two attempts appended to a database, the first run twice; what the table has, read back in parts."""
    options = {"url": f"jdbc:derby:memory:{new_path(spark, 'db').rpartition('-')[2]};create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("KEY_ID"), F.col("o_orderstatus").alias("STATUS"))
    for part, tag in (("STATUS = 'F'", "done"), ("STATUS = 'F'", "done"), ("STATUS <> 'F'", "open")):
        sinks.append_jdbc(rows.filter(part), options, "ORDERS", tag)
    most = rows.agg(F.max("KEY_ID")).first()[0]
    return files.read_jdbc(spark, options, 'SELECT "KEY_ID", "STATUS", "ATTEMPT_ID" FROM ORDERS', ("KEY_ID", 0, most + 1, 4))


@add("s1_header_violations", "SELECT 'swapped' AS folder, 'missing_column' AS reason, 'c_name,c_custkey' AS header, CAST(5 AS BIGINT) AS n_files", base=False)
def s1_header_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as files in two folders, in one with the columns in another order: every file there is listed."""
    from tallymart.contracts import contract

    root, rows = new_path(spark, "headers"), table(spark, sf_dir, "customer").select("c_custkey", "c_name").repartition(5)
    sinks.write_csv_export(rows, f"{root}/good")
    sinks.write_csv_export(rows.select("c_name", "c_custkey"), f"{root}/swapped")
    c = contract("people", "c_custkey integer, c_name string", "c_custkey")
    found = files.header_violations(spark, f"{root}/good", c, "*.csv").unionByName(files.header_violations(spark, f"{root}/swapped", c, "*.csv"))
    return found.groupBy(F.element_at(F.split("path", "/"), -2).alias("folder"), "reason", "header").agg(F.count("*").alias("n_files"))


add("s13_file_manifests")(lambda spark, sf_dir: files.file_manifests(spark, f"{sf_dir}/orders.parquet", "b1", D.BATCH, "*.parquet"))


@add("s14_register_tables", "SELECT c_custkey, c_name FROM customer", base=False)
def s14_register_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymart.contracts import contract

    path = new_path(spark, "registered")
    root, _, name = path.rpartition("/")
    c = contract(name.replace("-", "_"), "c_custkey integer, c_name string")
    sinks.write_layer(parsing.project_contract(table(spark, sf_dir, "customer"), c), f"{root}/{c.name}")
    sinks.register_tables(spark, [c], root)
    return spark.table(c.name)


@add("p4_project_contract", "SELECT CAST(o_custkey AS INT) AS owner, CAST(o_totalprice AS DECIMAL(14,2)) AS total, o_orderkey FROM orders", base=False)
def p4_project_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymart.contracts import contract

    rows = table(spark, sf_dir, "orders").withColumnsRenamed({"o_custkey": "owner", "o_totalprice": "total"})
    return parsing.project_contract(rows, contract("orders", "owner integer, total decimal(14,2)"), ["o_orderkey"])


@add("q18_assert_schema", "SELECT CAST(o_orderkey AS INT) AS o_orderkey, o_orderstatus FROM orders", base=False)
def q18_assert_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after its check; the table as it stands, with other columns, must not pass."""
    from tallymart.contracts import SchemaMismatch, assert_schema, contract

    c, rows = contract("orders", "o_orderkey integer, o_orderstatus string"), table(spark, sf_dir, "orders")
    try:
        assert_schema(rows, c)
    except SchemaMismatch:
        return assert_schema(parsing.project_contract(rows, c), c)
    raise AssertionError("a table with other columns has passed")


PROBES = {"expensive": "o_totalprice > 100000", "none": "o_orderkey < 0", "finished": "o_orderstatus = 'F'"}
add("o2_existence", " UNION ALL ".join(f"SELECT '{n}' AS probe, count(*) > 0 AS has_rows FROM orders WHERE {x}" for n, x in PROBES.items()), base=False)(
    lambda spark, sf_dir: P.existence({n: table(spark, sf_dir, "orders").filter(x) for n, x in PROBES.items()})
)
add("s4_read_layer", "SELECT * FROM supplier", base=False)(lambda spark, sf_dir: table(spark, sf_dir, "supplier"))
add("s16_load_columns", "SELECT o_custkey, o_orderkey FROM orders", base=False)(lambda spark, sf_dir: P.load_columns(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderkey"]))
on_star("p15_stamp", "SELECT \"CustomerState\", count(DISTINCT \"OrderID\") AS \"OrdersCount\", TIMESTAMP '2018-04-01' AS \"LastUpdated\" FROM e GROUP BY 1", lambda t: derive.stamp(M.sales_by_state(t["enriched"]).select("CustomerState", "OrdersCount"), D.BATCH))
add("h8_publication_events", "SELECT CAST(o_orderkey AS VARCHAR) AS batch_id, unnest(CASE WHEN o_orderstatus = 'F' THEN ['STARTED', 'COMPLETED'] WHEN o_orderstatus = 'O' THEN ['NO_OP'] ELSE ['CONFLICT'] END) AS event, TIMESTAMP '2018-04-01' AS recorded_at FROM orders", base=False)(
    lambda spark, sf_dir: P.publication_events(table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey AS STRING) AS batch_id", "CASE o_orderstatus WHEN 'F' THEN 'PUBLISH' WHEN 'O' THEN 'NO_OP' ELSE 'CONFLICT' END AS decision"), D.BATCH)
)
add("o4_union_and_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier", base=False)(lambda spark, sf_dir: table(spark, sf_dir, "customer").selectExpr("c_nationkey AS nation").unionByName(table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS nation")).distinct())


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
