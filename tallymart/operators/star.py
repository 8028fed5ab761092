"""Dimensions and facts from processed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallymart.functions.derive import cross_flag, date_key, size_category, snapshot_columns, unsentinel, volume
from tallymart.tables import unused, written

Frames = Mapping[str, DataFrame]

#: Status, description and the flags approved, delivered, shipped, cancelled.
STATUSES = [
    ("CREATED", "Created", False, False, False, False),
    ("APPROVED", "Approved", True, False, False, False),
    ("SHIPPED", "Shipped", True, False, True, False),
    ("DELIVERED", "Delivered", True, True, True, False),
    ("CANCELLED", "Cancelled", False, False, False, True),
    ("UNAVAILABLE", "Unavailable", False, False, False, False),
]


def representative(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key by the order, nulls first.

    A minimum over a struct rather than a numbered window: it combines before the shuffle and needs no sort of
    a key's rows.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    first = F.min(F.struct(*order_by, *rest)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*[c if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def join_inner(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "inner")


def join_left(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "left")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null keys equal null keys; the keys come once."""
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, on, how).drop(*[f"_r_{k}" for k in keys])


def translate(df: DataFrame, lookup: DataFrame, key: str, value: str, fallback: str) -> DataFrame:
    """value from the lookup (key, value), the fallback where the key is null or unknown. Spark picks the join by the lookup's size."""
    return df.join(lookup.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(fallback)))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def with_match_flag(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, flag: str = "has_parent") -> DataFrame:
    keys = parent.select(F.col(parent_key).alias("_p")).distinct()
    return child.join(keys, F.col(child_key) == F.col("_p"), "left").withColumn(flag, F.col("_p").isNotNull()).drop("_p")


def lookup_keys(fact: DataFrame, dimension: DataFrame, business_key: str, surrogate: str, how: str = "inner", current: str | None = "CurrentFlag") -> DataFrame:
    rows = dimension.filter(F.col(current)) if current and current in dimension.columns else dimension
    return fact.join(rows.select(business_key, surrogate), business_key, how)


def dim_customer(customers: DataFrame, batch: str) -> DataFrame:
    names = {"customer_id": "CustomerID", "customer_unique_id": "CustomerUniqueID", "customer_zip_code_prefix": "CustomerZipCodePrefix", "customer_city": "CustomerCity", "customer_state": "CustomerState"}
    return snapshot_columns(customers.select(*[F.col(k).alias(v) for k, v in names.items()]), batch)


def dim_seller(sellers: DataFrame, batch: str) -> DataFrame:
    names = {"seller_id": "SellerID", "seller_zip_code_prefix": "SellerZipCodePrefix", "seller_city": "SellerCity", "seller_state": "SellerState"}
    return snapshot_columns(sellers.select(*[F.col(k).alias(v) for k, v in names.items()]), batch)


def dim_product(products: DataFrame, batch: str) -> DataFrame:
    v = volume(F.col("product_length_cm"), F.col("product_height_cm"), F.col("product_width_cm"))
    rows = products.select(
        F.col("product_id").alias("ProductID"), F.col("product_category_name").alias("ProductCategoryName"), F.col("product_category_name_english").alias("ProductCategoryNameEnglish"),
        F.col("product_weight_g").alias("ProductWeightG"), F.col("product_length_cm").alias("ProductLengthCm"), F.col("product_height_cm").alias("ProductHeightCm"),
        F.col("product_width_cm").alias("ProductWidthCm"), v.alias("ProductVolumeCm3"), size_category(v).alias("SizeCategory"),
    )
    return snapshot_columns(rows, batch)


def dim_geography(geolocation: DataFrame, batch: str) -> DataFrame:
    """The first place of each zip prefix by city, state, latitude and longitude."""
    names = {"geolocation_zip_code_prefix": "ZipCodePrefix", "geolocation_city": "City", "geolocation_state": "State", "geolocation_lat": "Latitude", "geolocation_lng": "Longitude"}
    rows = geolocation.select(*[F.col(k).alias(v) for k, v in names.items()])
    return snapshot_columns(representative(rows, ["ZipCodePrefix"], ["City", "State", "Latitude", "Longitude"]).withColumn("Region", F.lit(None).cast("string")), batch)


def geo_centroid(geolocation: DataFrame) -> DataFrame:
    """Smallest city with its state, mean latitude and longitude of each zip prefix."""
    first = F.min(F.struct("geolocation_city", "geolocation_state"))
    out = geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("ZipCodePrefix")).agg(first.alias("f"), F.avg(F.col("geolocation_lat").cast("double")).alias("Latitude"), F.avg(F.col("geolocation_lng").cast("double")).alias("Longitude"))
    return out.select("ZipCodePrefix", F.col("f.geolocation_city").alias("City"), F.col("f.geolocation_state").alias("State"), "Latitude", "Longitude")


def date_bounds(orders: DataFrame, to_estimate: bool = True) -> DataFrame:
    """first_day, last_day. to_estimate: from the month's start to the last estimated delivery; else first to last purchase."""
    bought, due = F.col("order_purchase_timestamp"), F.coalesce("order_estimated_delivery_date", "order_purchase_timestamp")
    first, last = (F.trunc(F.min(bought), "month"), F.max(due)) if to_estimate else (F.min(bought), F.max(bought))
    return orders.agg(F.to_date(first).alias("first_day"), F.to_date(last).alias("last_day"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """A row for each day between first_day and last_day."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("Date"))


def dim_date(bounds: DataFrame, fiscal_start_month: int = 1) -> DataFrame:
    """Calendar columns of every day. The fiscal year is named after the calendar year in which it ends."""
    d = F.col("Date")
    shift = (13 - fiscal_start_month) % 12
    fiscal = F.add_months(d, shift)
    return date_spine(bounds).select(
        date_key("Date").alias("DateKey"), date_key("Date").alias("DateID"), d, F.year(d).alias("Year"), F.month(d).alias("Month"), F.dayofmonth(d).alias("Day"),
        F.quarter(d).alias("Quarter"), F.weekofyear(d).alias("WeekOfYear"), F.dayofweek(d).alias("DayOfWeek"), F.dayofweek(d).isin(1, 7).alias("IsWeekend"),
        F.date_format(d, "MMMM").alias("MonthName"), F.date_format(d, "EEEE").alias("DayName"), F.year(fiscal).alias("FiscalYear"), F.quarter(fiscal).alias("FiscalQuarter"),
        F.lit(None).cast("string").alias("Holiday"), F.lit(False).alias("IsHoliday"),
    )


def dim_order_status(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATUSES, "StatusID string, StatusDescription string, IsApproved boolean, IsDelivered boolean, IsShipped boolean, IsCancelled boolean")


#: Rows of a narrow lookup that go to every task; Spark takes a join for as large as the product of its sides and never would.
BROADCAST_ROWS = 500_000


def fitting(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


#: Items that a task sorts, joins to their orders and reduces to (group, order) pairs in memory.
ITEMS_A_TASK = 500_000


def in_memory(items: DataFrame, key: str, rows: int) -> DataFrame:
    """items, about so many rows, shuffled by the key to as many partitions as hold ITEMS_A_TASK each, if the session's shuffles have fewer; what joins them follows."""
    most = -(-rows // ITEMS_A_TASK)
    return items.repartition(most, key) if most > int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")) else items


def sales_rows(frames: Frames, dims: Frames | None = None) -> DataFrame:
    """fact_sales, and with dims what enrich adds to it.

    Each lookup is joined to the side that has its key, items or orders, while rows are narrow; then both sides meet by the order, always by
    a shuffle, so that the rows of an order stay together and marts find their (group, order) pairs without another one.
    """
    items, orders = frames["order_items"], frames["orders"].join(frames["customers"].select("customer_id", "customer_zip_code_prefix", "customer_state"), "customer_id")
    more = []
    if dims is not None:
        items = items.join(dims["dim_product"].select(F.col("ProductID").alias("product_id"), "ProductCategoryNameEnglish", "SizeCategory"), "product_id")
        items = items.join(fitting(dims["dim_seller"].select(F.col("SellerID").alias("seller_id"), "SellerState")), "seller_id")
        orders = orders.join(dims["dim_customer"].select(F.col("CustomerID").alias("customer_id"), "CustomerState"), "customer_id")
        more = ["ProductCategoryNameEnglish", "SizeCategory", "CustomerState", "SellerState"]
    items = items.join(fitting(frames["sellers"].select("seller_id", "seller_state")), "seller_id")
    first_payment = representative(frames["order_payments"].select("order_id", "payment_sequential", "payment_type"), ["order_id"], ["payment_sequential", "payment_type"])
    rows = in_memory(items, "order_id", frames["order_items"].count()).hint("merge").join(orders, "order_id").hint("merge").join(first_payment.select("order_id", "payment_type"), "order_id", "left")
    return rows.select(
        F.col("order_id").alias("OrderID"), F.col("order_item_id").alias("OrderItemID"), F.col("customer_id").alias("CustomerID"), F.col("product_id").alias("ProductID"), F.col("seller_id").alias("SellerID"),
        date_key("order_purchase_timestamp").alias("DateKey"), F.col("order_status").alias("StatusID"), F.col("customer_zip_code_prefix").alias("ZipCodePrefix"),
        F.col("order_purchase_timestamp").alias("OrderPurchaseTimestamp"), F.col("order_delivered_customer_date").alias("OrderDeliveredCustomerDate"),
        F.col("price").alias("Price"), F.col("freight_value").alias("FreightValue"), (F.col("price") + F.col("freight_value")).alias("TotalItemValue"),
        unsentinel(F.col("shipping_days")).alias("ShippingDays"), unsentinel(F.col("delivery_days")).alias("DeliveryDays"), unsentinel(F.col("total_days")).alias("TotalDays"),
        F.coalesce("is_delayed", F.lit(False)).alias("IsDelayed"), F.col("delay_days").alias("DelayDays"), cross_flag(F.col("customer_state"), F.col("seller_state")).alias("IsCrossState"),
        F.col("payment_type").alias("PaymentType"), *more,
    )


def fact_sales(frames: Frames) -> DataFrame:
    """A row for each order item with its order, customer, seller and representative payment.

    Items, orders, customers and sellers must match; a payment need not. Missing days are null and an order
    without delivery is not delayed.
    """
    return sales_rows(frames)


def enriched_sales(frames: Frames, dims: Frames) -> DataFrame:
    """The rows of enrich(fact_sales(frames), dims); items are shuffled for their product and their order only, not for each dimension."""
    return sales_rows(frames, dims)


def fact_reviews(frames: Frames) -> DataFrame:
    rows = frames["order_reviews"].join(frames["orders"].select("order_id", "customer_id", "order_purchase_timestamp"), "order_id")
    return rows.select(
        F.col("order_id").alias("OrderID"), F.col("review_id").alias("ReviewID"), F.col("customer_id").alias("CustomerID"), date_key("order_purchase_timestamp").alias("DateKey"), F.col("review_score").alias("ReviewScore"),
        F.col("review_comment_message").alias("ReviewCommentMessage"), F.col("review_creation_date").alias("ReviewCreationDate"), F.col("review_answer_timestamp").alias("ReviewAnswerTimestamp"),
        F.datediff("review_answer_timestamp", "review_creation_date").alias("ReviewResponseDays"),
    )


def enrich(sales: DataFrame, dims: Frames) -> DataFrame:
    """Sales with the dimension columns that the marts group by."""
    out = sales.join(dims["dim_product"].select("ProductID", "ProductCategoryNameEnglish", "SizeCategory"), "ProductID")
    out = out.join(dims["dim_customer"].select("CustomerID", "CustomerState"), "CustomerID")
    return out.join(dims["dim_seller"].select("SellerID", "SellerState"), "SellerID")


def allocate_keys(new: DataFrame, existing: DataFrame, business_key: str, surrogate: str) -> DataFrame:
    """new rows with surrogate = largest existing + rank by business key, dense; equal keys in any order.

    The rows are range-sorted once and written with their place, so that counting them and numbering them see the same
    partitions. A row for each partition (its number of rows) is added up, each partition counts on from there. No partition
    sees all rows.
    """
    spark = new.sparkSession
    at, part, before = (unused(c, new) for c in ("_at", "_part", "_before"))
    sorted_rows = new.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), business_key).sortWithinPartitions(business_key)
    # The upper 31 bits of these numbers are the partition, the lower 33 the row's place in it.
    placed = written(sorted_rows.withColumn(at, F.monotonically_increasing_id()), "key-places").withColumn(part, F.shiftright(at, 33))
    last = existing.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]
    counts = placed.groupBy(part).agg(F.count("*").alias("n"))
    sums = F.coalesce(F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(part, (F.lit(last) + sums).alias(before))
    rows = placed.join(F.broadcast(starts), part)  # a row a partition
    rank = F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.withColumn(surrogate, (F.col(before) + rank).cast("long")).select(*new.columns, surrogate)


def next_effective(df: DataFrame, keys: Sequence[str], effective: str, name: str = "RowExpirationDate") -> DataFrame:
    return df.withColumn(name, F.lead(effective).over(Window.partitionBy(*keys).orderBy(effective)))
