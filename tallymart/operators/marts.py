"""Aggregates over the sales fact.

Most marts count distinct orders and customers of a group. Instead of several distinct counts at once, which
multiply every row, a group is first reduced to its (group, order) pairs: an order belongs to one customer and
carries sums, so orders and delayed orders are plain counts after that. Customers take one more
reduction of the pairs. The first step combines before the shuffle.

Where several marts come from one table, `marked` notes the first row of every pair while the rows of an order are together. A mart
then adds up marks instead of building pairs, and only the distinct (group, customer) are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

MONEY = "decimal(38,2)"


def pairs(enriched: DataFrame, group: Sequence[str]) -> DataFrame:
    """A row for each group and order: items, sales, freight, days and whether an item was late."""
    return enriched.groupBy(*group, "OrderID").agg(
        F.min("CustomerID").alias("CustomerID"), F.count("*").alias("items"), F.sum("Price").alias("sales"), F.sum("FreightValue").alias("freight"),
        F.sum("TotalDays").alias("days"), F.count("TotalDays").alias("with_days"), F.max(F.col("IsDelayed").cast("int")).alias("late"),
    )


def ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a.cast("double") / b.cast("double"))


#: What the marts of the enriched sales group by; payment_methods groups the sales by PaymentType.
GROUPS = (
    ("CustomerState",), ("ProductCategoryNameEnglish",), ("Year", "Month"), ("ProductCategoryNameEnglish", "OrderStatus"), ("ProductCategoryNameEnglish", "IsCrossState"), ("SellerID", "SellerState"),
    ("ProductCategoryNameEnglish", "SizeCategory"),
)


def mark(group: Sequence[str]) -> str:
    return "_first_" + "_".join(group)


def marked(rows: DataFrame, groups: Sequence[Sequence[str]] = GROUPS) -> DataFrame:
    """rows with what monthly_sales and order_status group by, and for each group whether a row is the first of its (group, order), late rows first.

    The windows take the rows as the join by the order leaves them, without a shuffle.
    """
    names = {c for g in groups for c in g}
    named = {"Year": F.year("OrderPurchaseTimestamp"), "Month": F.month("OrderPurchaseTimestamp"), "OrderStatus": F.col("StatusID")}
    rows = rows.withColumns({n: c for n, c in named.items() if n in names and n not in rows.columns})
    for group in groups:
        rows = rows.withColumn(mark(group), F.row_number().over(Window.partitionBy("OrderID", *group).orderBy(F.desc_nulls_last("IsDelayed"))) == 1)
    return rows


def for_marts(rows: DataFrame, *more: str) -> DataFrame:
    """The columns of marked sales that marts take, and more."""
    taken = {"OrderID", "CustomerID", "Price", "FreightValue", "TotalDays", "IsDelayed", "OrderPurchaseTimestamp", "StatusID", "PaymentType", *more, *[c for g in GROUPS for c in g]}
    return rows.select(*[c for c in rows.columns if c in taken or c.startswith("_first_")])


def mart_of_marked(rows: DataFrame, group: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """mart, from marks: one grouping of the rows, and one of the distinct (group, customer) if customers are counted."""
    first, late = F.sum(F.col(mark(group)).cast("int")), F.sum(F.when(F.col(mark(group)), F.col("IsDelayed").cast("int")))
    forms = {
        "OrdersCount": first,
        "TotalSales": F.sum("Price").cast(MONEY),
        "AvgItemPrice": ratio(F.sum("Price"), F.count("*")),
        "AvgShippingCost": ratio(F.sum("FreightValue"), F.count("*")),
        "AvgDeliveryTime": ratio(F.sum("TotalDays"), F.count("TotalDays")),
        "DelayedOrders": late,
        "DelayRate": ratio(late, first),
        "AvgOrderValue": ratio(F.sum("Price"), first),
    }
    out = rows.groupBy(*group).agg(*[forms[m].alias(m) for m in measures if m != "UniqueCustomers"])
    if "UniqueCustomers" in measures:
        customers = rows.select(*group, "CustomerID").distinct().groupBy(*group).agg(F.count("CustomerID").alias("UniqueCustomers"))
        both = out.unionByName(customers, allowMissingColumns=True)  # two rows a group, which hold different columns
        out = both.groupBy(*group).agg(*[F.max(m).alias(m) for m in measures])
    return out.select(*group, *measures)


def mart(enriched: DataFrame, group: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The chosen measures of each group."""
    if mark(group) in enriched.columns:
        return mart_of_marked(enriched, group, measures)
    reduced = pairs(enriched, group)
    if "UniqueCustomers" in measures:
        # The same idea once more: (group, customer) with its orders added up.
        sums = [F.sum(c).alias(c) for c in ("items", "sales", "freight", "days", "with_days", "late")]
        reduced = reduced.groupBy(*group, "CustomerID").agg(F.count("*").alias("orders"), *sums)
    else:
        reduced = reduced.withColumn("orders", F.lit(1))
    forms = {
        "OrdersCount": F.sum("orders"),
        "UniqueCustomers": F.count("CustomerID"),
        "TotalSales": F.sum("sales").cast(MONEY),
        "AvgItemPrice": ratio(F.sum("sales"), F.sum("items")),
        "AvgShippingCost": ratio(F.sum("freight"), F.sum("items")),
        "AvgDeliveryTime": ratio(F.sum("days"), F.sum("with_days")),
        "DelayedOrders": F.sum("late"),
        "DelayRate": ratio(F.sum("late"), F.sum("orders")),
        "AvgOrderValue": ratio(F.sum("sales"), F.sum("orders")),
    }
    return reduced.groupBy(*group).agg(*[forms[m].alias(m) for m in measures])


def sales_by_category(enriched: DataFrame) -> DataFrame:
    return mart(enriched, ["ProductCategoryNameEnglish"], ["OrdersCount", "UniqueCustomers", "TotalSales", "AvgItemPrice", "AvgDeliveryTime", "DelayedOrders"])


def sales_by_state(enriched: DataFrame) -> DataFrame:
    return mart(enriched, ["CustomerState"], ["OrdersCount", "UniqueCustomers", "TotalSales", "AvgItemPrice", "AvgDeliveryTime"])


def monthly_sales(enriched: DataFrame) -> DataFrame:
    rows = enriched.withColumns({"Year": F.year("OrderPurchaseTimestamp"), "Month": F.month("OrderPurchaseTimestamp")})
    return mart(rows, ["Year", "Month"], ["OrdersCount", "UniqueCustomers", "TotalSales", "AvgItemPrice"])


def order_status(enriched: DataFrame) -> DataFrame:
    return mart(enriched.withColumn("OrderStatus", F.col("StatusID")), ["ProductCategoryNameEnglish", "OrderStatus"], ["OrdersCount", "TotalSales", "UniqueCustomers"])


def cross_state_analysis(enriched: DataFrame) -> DataFrame:
    return mart(enriched, ["ProductCategoryNameEnglish", "IsCrossState"], ["OrdersCount", "TotalSales", "AvgDeliveryTime", "DelayRate"])


def seller_performance(enriched: DataFrame) -> DataFrame:
    return mart(enriched, ["SellerID", "SellerState"], ["OrdersCount", "TotalSales", "AvgShippingCost", "AvgDeliveryTime", "DelayedOrders", "DelayRate"])


def size_analysis(enriched: DataFrame) -> DataFrame:
    return mart(enriched, ["ProductCategoryNameEnglish", "SizeCategory"], ["OrdersCount", "TotalSales", "AvgShippingCost"])


def payment_methods(sales: DataFrame) -> DataFrame:
    return mart(sales.filter(F.col("PaymentType").isNotNull()), ["PaymentType"], ["OrdersCount", "TotalSales", "AvgOrderValue", "UniqueCustomers"])


def payment_methods_two_level(sales: DataFrame) -> DataFrame:
    """Order values first, then payment types; null is a type."""
    orders = sales.groupBy("OrderID", "PaymentType", "CustomerID").agg(F.sum("Price").alias("value"))
    by_customer = orders.groupBy("PaymentType", "CustomerID").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return by_customer.groupBy("PaymentType").agg(F.sum("n").alias("OrdersCount"), F.sum("value").cast(MONEY).alias("TotalSales"), ratio(F.sum("value"), F.sum("n")).alias("AvgOrderValue"), F.count("CustomerID").alias("UniqueCustomers"))


def orders_by_date_state(sales: DataFrame, dim_date: DataFrame, dim_customer: DataFrame) -> DataFrame:
    rows = sales.join(dim_date.select("DateKey", "Year", "Month", "MonthName"), "DateKey").join(dim_customer.select("CustomerID", "CustomerState"), "CustomerID")
    group = ["Year", "Month", "MonthName", "CustomerState"]
    orders = rows.groupBy(*group, "OrderID").agg(F.sum("TotalItemValue").alias("value"))
    return orders.groupBy(*group).agg(F.count("*").alias("OrdersCount"), F.sum("value").cast(MONEY).alias("TotalValue"))


def product_category_sales(enriched: DataFrame) -> DataFrame:
    group = "ProductCategoryNameEnglish"
    orders = enriched.groupBy(group, "OrderID").agg(F.sum("TotalItemValue").alias("value"), F.sum("Price").alias("sales"), F.count("*").alias("items"))
    return orders.groupBy(group).agg(F.count("*").alias("OrdersCount"), F.sum("value").cast(MONEY).alias("TotalValue"), ratio(F.sum("sales"), F.sum("items")).alias("AvgPrice"))


def status_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(F.count("*").alias("n_orders")).orderBy("order_status")


def all_marts(enriched: DataFrame, sales: DataFrame) -> dict[str, DataFrame]:
    """The eight marts by name."""
    forms = (sales_by_state, sales_by_category, monthly_sales, order_status, cross_state_analysis, seller_performance, size_analysis)
    return {**{f.__name__: f(enriched) for f in forms}, "payment_methods": payment_methods(sales)}


def metrics_summary(sales: DataFrame) -> DataFrame:
    """One row: fact rows, orders, same- and cross-state items, delayed items, gross value."""
    orders = sales.groupBy("OrderID").agg(F.count("*").alias("n"), F.count_if(~F.col("IsCrossState")).alias("same"), F.count_if("IsCrossState").alias("cross"), F.count_if("IsDelayed").alias("late"), F.sum("TotalItemValue").alias("gross"))
    return orders.agg(F.sum("n").alias("sales_rows"), F.count("*").alias("orders"), F.sum("same").alias("same_state"), F.sum("cross").alias("cross_state"), F.sum("late").alias("delayed"), F.sum("gross").cast(MONEY).alias("gross_value"))


def reconcile_totals(sales: DataFrame, marts: Mapping[str, DataFrame]) -> DataFrame:
    """mart, fact_total, mart_total, matches. payment_methods is held against the rows with a payment type."""
    paid = F.sum(F.when(F.col("PaymentType").isNotNull(), F.col("Price")))
    form = lambda name: (paid if name == "payment_methods" else F.sum("Price")).cast(MONEY)
    fact = sales.agg(F.map_from_arrays(F.array(*[F.lit(n) for n in marts]), F.array(*[form(n) for n in marts])).alias("totals"))
    fact = fact.select(F.explode("totals").alias("mart", "fact_total"))
    totals = reduce(DataFrame.unionByName, [df.agg(F.lit(name).alias("mart"), F.sum("TotalSales").cast(MONEY).alias("mart_total")) for name, df in marts.items()])
    return fact.join(totals, "mart").withColumn("matches", F.col("fact_total").eqNullSafe(F.col("mart_total")))
