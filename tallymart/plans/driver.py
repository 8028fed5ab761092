"""The driver's tables in the roles of a marketplace: processed-level frames for the star builders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymart.functions.derive import with_order_columns
from tallymart.operators.star import dim_customer, dim_date, dim_geography, dim_product, dim_seller, date_bounds, enriched_sales, fact_reviews, fact_sales, translate

BATCH = "2018-04-01 00:00:00"
CATEGORIES = [("ECONOMY", "economy goods"), ("STANDARD", "standard goods"), ("PROMO", "promotions"), ("LARGE", "large goods")]


def days(column: str, n: str) -> str:
    return f"timestampadd(DAY, {n}, {column})"


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Milestones follow from order date and key: shipped within 5 days unless open, delivered within 83 if finished."""
    key = "CAST(o_orderkey AS INT)"
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey AS order_id", "o_custkey AS customer_id",
        "CASE WHEN o_orderkey % 50 = 7 THEN 'canceled' WHEN o_orderkey % 50 = 9 THEN 'unavailable' ELSE lower(o_orderstatus) END AS order_status",
        "o_orderdate AS order_purchase_timestamp", f"CASE WHEN o_orderkey % 11 <> 0 THEN {days('o_orderdate', '1')} END AS order_approved_at",
        f"CASE WHEN o_orderstatus <> 'O' THEN {days('o_orderdate', f'1 + {key} % 5')} END AS order_delivered_carrier_date",
        f"CASE WHEN o_orderstatus = 'F' THEN {days('o_orderdate', f'3 + {key} % 80')} END AS order_delivered_customer_date",
        f"{days('o_orderdate', '60')} AS order_estimated_delivery_date",
    )


def frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    nation = read("nation").select("n_nationkey", "n_name")
    size = lambda n: f"CAST(CASE WHEN p_size % 10 <> 0 THEN {n} END AS DECIMAL(10,3))"
    products = read("part").selectExpr("p_partkey AS product_id", "p_type AS product_category_name", f"{size('p_size')} AS product_weight_g", f"{size('p_size')} AS product_length_cm", f"{size('p_size % 20')} AS product_height_cm", f"{size('p_size % 30')} AS product_width_cm")
    lookup = F.broadcast(spark.createDataFrame(CATEGORIES, "product_category_name string, product_category_name_english string"))  # a row a category
    price, tax = "CAST(l_extendedprice AS DECIMAL(12,2))", "CAST(l_tax AS DECIMAL(4,2))"
    return {
        "orders": with_order_columns(raw_orders(spark, sf_dir)),
        "order_items": read("lineitem").selectExpr("l_orderkey AS order_id", "l_linenumber AS order_item_id", "l_partkey AS product_id", "l_suppkey AS seller_id", "l_shipdate AS shipping_limit_date", f"{price} AS price", f"CAST({price} * {tax} AS DECIMAL(12,2)) AS freight_value"),
        "customers": read("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr("c_custkey AS customer_id", "c_name AS customer_unique_id", "c_nationkey AS customer_zip_code_prefix", "c_mktsegment AS customer_city", "n_name AS customer_state"),
        "sellers": read("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr("s_suppkey AS seller_id", "s_nationkey AS seller_zip_code_prefix", "s_name AS seller_city", "n_name AS seller_state"),
        "products": translate(products, lookup, "product_category_name", "product_category_name_english", "uncategorized"),
        "order_payments": read("events").selectExpr("CAST(floor(event_id / 2) AS BIGINT) AS order_id", "CAST(2 - event_id % 2 AS INT) AS payment_sequential", "event_type AS payment_type", "CAST(value AS DECIMAL(12,2)) AS payment_value"),
        "order_reviews": read("events").filter("event_type = 'view'").selectExpr("event_id AS review_id", "event_id AS order_id", "CAST(1 + event_id % 7 AS INT) AS review_score", "props AS review_comment_message", "ts AS review_creation_date", f"{days('ts', 'CAST(event_id % 10 AS INT)')} AS review_answer_timestamp"),
        "geolocation": read("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr("s_nationkey AS geolocation_zip_code_prefix", "CAST(s_acctbal AS DECIMAL(12,2)) AS geolocation_lat", "CAST(s_suppkey AS DECIMAL(12,2)) AS geolocation_lng", "s_name AS geolocation_city", "n_name AS geolocation_state"),
    }


def dimensions(f: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "dim_customer": dim_customer(f["customers"], BATCH), "dim_product": dim_product(f["products"], BATCH), "dim_seller": dim_seller(f["sellers"], BATCH),
        "dim_geography": dim_geography(f["geolocation"], BATCH), "dim_date": dim_date(date_bounds(f["orders"], to_estimate=False)),
    }


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All frames, dimensions, facts and the enriched sales."""
    f = frames(spark, sf_dir)
    dims = dimensions(f)
    return {**f, **dims, "fact_sales": fact_sales(f), "fact_reviews": fact_reviews(f), "enriched": enriched_sales(f, dims)}
