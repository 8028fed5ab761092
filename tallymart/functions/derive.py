"""Derived columns of orders, products and facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Source values that end a status whatever the milestones say, and milestones by precedence.
TERMINAL = {"canceled": "CANCELLED", "cancelled": "CANCELLED", "unavailable": "UNAVAILABLE"}
MILESTONES = {"DELIVERED": "order_delivered_customer_date", "SHIPPED": "order_delivered_carrier_date", "APPROVED": "order_approved_at"}


def derive_status(status: Column, terminal: Mapping[str, str] = TERMINAL, milestones: Mapping[str, str] = MILESTONES, otherwise: str = "CREATED") -> Column:
    """Terminal source values first, then the first milestone that is there. With an empty map only milestones count."""
    rules = [(F.lower(status) == k, v) for k, v in terminal.items()] + [(F.col(c).isNotNull(), name) for name, c in milestones.items()]
    (first, value), *rest = rules
    out = F.when(first, value)
    for condition, name in rest:
        out = out.when(condition, name)
    return out.otherwise(otherwise)


def elapsed_days(start: str, end: str) -> Column:
    """Whole days between two dates, null if either is missing."""
    return F.datediff(F.col(end), F.col(start))


def delay_columns(delivered: str, estimated: str) -> dict[str, Column]:
    late = F.col(delivered) > F.col(estimated)
    return {"is_delayed": late, "delay_days": F.when(late, F.datediff(F.col(delivered), F.col(estimated))).otherwise(0).cast("int")}


def presence_flags(columns: Mapping[str, str]) -> dict[str, Column]:
    return {flag: F.col(c).isNotNull() for flag, c in columns.items()}


def date_parts(column: str, prefix: str) -> dict[str, Column]:
    return {f"{prefix}_year": F.year(column), f"{prefix}_month": F.month(column), f"{prefix}_day": F.dayofmonth(column)}


def date_key(column: str | Column) -> Column:
    """yyyyMMdd as a number."""
    c = F.col(column) if isinstance(column, str) else column
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def with_order_columns(orders: DataFrame, terminal: Mapping[str, str] = TERMINAL) -> DataFrame:
    """Status, date parts, elapsed days, delay and presence flags of orders; missing days are -1 in the last three."""
    days = {
        "shipping_time_days": elapsed_days("order_approved_at", "order_delivered_carrier_date"),
        "delivery_time_days": elapsed_days("order_delivered_carrier_date", "order_delivered_customer_date"),
        "total_delivery_time_days": elapsed_days("order_purchase_timestamp", "order_delivered_customer_date"),
    }
    out = orders.withColumns({"order_status": derive_status(F.col("order_status"), terminal), **date_parts("order_purchase_timestamp", "order"), **days})
    out = out.withColumns({**delay_columns("order_delivered_customer_date", "order_estimated_delivery_date"), **presence_flags({"is_approved": "order_approved_at", "is_shipped": "order_delivered_carrier_date", "is_delivered": "order_delivered_customer_date"})})
    return out.withColumns({k: sentinel(F.col(c)) for k, c in (("shipping_days", "shipping_time_days"), ("delivery_days", "delivery_time_days"), ("total_days", "total_delivery_time_days"))})


def sentinel(days: Column) -> Column:
    return F.coalesce(days, F.lit(-1))


def unsentinel(days: Column) -> Column:
    return F.when(days >= 0, days)


def volume(length: Column, height: Column, width: Column) -> Column:
    """Product of three sizes at scale 3, so that the result keeps all digits."""
    at = [c.cast("decimal(10,3)") for c in (length, height, width)]
    return at[0] * at[1] * at[2]


def size_category(v: Column, limits: Sequence[tuple[int, str]] = ((1000, "Small"), (8000, "Medium")), largest: str = "Large") -> Column:
    out = F.when(v.isNull(), "Unknown")
    for limit, name in limits:
        out = out.when(v < limit, name)
    return out.otherwise(largest)


def cross_flag(a: Column, b: Column, unknown: bool | None = None) -> Column:
    """Whether two states differ; `unknown` where either is missing."""
    return F.coalesce(a != b, F.lit(unknown).cast("boolean")) if unknown is not None else a != b


def snapshot_columns(df: DataFrame, batch_timestamp: str) -> DataFrame:
    return df.withColumns({"RowEffectiveDate": F.lit(batch_timestamp).cast("timestamp"), "RowExpirationDate": F.lit(None).cast("timestamp"), "CurrentFlag": F.lit(True)})


def stamp(df: DataFrame, batch_timestamp: str) -> DataFrame:
    return df.withColumn("LastUpdated", F.lit(batch_timestamp).cast("timestamp"))


def valid_scores(df: DataFrame, column: str = "review_score") -> DataFrame:
    return df.filter(F.col(column).between(1, 5))
