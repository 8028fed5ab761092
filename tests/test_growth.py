"""What a query shuffles does not grow faster than its input: the plans without automatic broadcasts, as large tables get them."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tallymart.operators import history as H, marts as M, star as S
from tallymart.plans import driver as D


@contextmanager
def large(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """Shuffles by a key, but those that look up a nation."""
    return sum("Exchange hashpartitioning" in line and "nationkey" not in line for line in plan(df).splitlines())


@pytest.mark.parametrize(("name", "most"), [("a6_seller_performance", 8), ("a5_cross_state_analysis", 8), ("a1_sales_by_category", 9), ("d7_fact_sales", 5)])
def test_items_are_shuffled_for_their_product_and_order_only(spark, sf_dir, name, most):
    from tallymart import catalog

    with large(spark):
        assert exchanges(catalog.queries()[name](spark, sf_dir)) <= most


def test_items_meet_their_orders_in_partitions_by_their_number(spark, sf_dir, monkeypatch):
    from tallymart import catalog

    want = catalog.queries()["a1_sales_by_category"](spark, sf_dir)
    monkeypatch.setattr(S, "ITEMS_A_TASK", 500, raising=False)
    got = catalog.queries()["a1_sales_by_category"](spark, sf_dir)
    n = -(-D.frames(spark, sf_dir)["order_items"].count() // 500)
    by_order = [line for line in plan(got).splitlines() if "Exchange hashpartitioning(order_id" in line]
    assert len(by_order) >= 2 and sum(f", {n})" in line or f", {n}," in line for line in by_order) >= 2
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_enriched_sales_are_the_enriched_fact(spark, sf_dir, monkeypatch):
    f = D.frames(spark, sf_dir)
    f |= {"sellers": f["sellers"].filter("seller_id % 7 <> 1"), "products": f["products"].filter("product_id % 5 <> 1"), "customers": f["customers"].filter("customer_id % 3 <> 1")}
    dims = D.dimensions(f)
    dims["dim_seller"] = dims["dim_seller"].filter("SellerID % 7 <> 2").withColumn("SellerState", F.upper("SellerState"))
    dims["dim_customer"] = dims["dim_customer"].filter("CustomerID % 3 <> 2")
    want = S.enrich(S.fact_sales(f), dims)
    for most in (S.BROADCAST_ROWS, 0):
        monkeypatch.setattr(S, "BROADCAST_ROWS", most)
        got = S.enriched_sales(f, dims).select(*want.columns)
        assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_marts_of_a_written_table_shuffle_no_pairs_of_group_and_order(spark, sf_dir):
    from tallymart import catalog

    assert not [line for line in plan(catalog.queries()["a15_reconcile_totals"](spark, sf_dir)).splitlines() if "Exchange" in line and "OrderID" in line]


def test_marts_from_marks_are_the_marts(spark):
    rows = [(o, o % 3 if o % 5 else None, "ab"[i % 2] if i < 4 else None, i % 3 != 1 if o % 2 else None, 1.5 * i, i if i % 2 else None) for o in range(40) for i in range(o % 7)]
    df = spark.createDataFrame(rows, "OrderID long, CustomerID long, PaymentType string, IsDelayed boolean, price double, TotalDays int").selectExpr("*", "CAST(price AS DECIMAL(12,2)) AS Price1", "CAST(price + 1 AS DECIMAL(12,2)) AS FreightValue").drop("price").withColumnRenamed("Price1", "Price")
    measures = ["OrdersCount", "UniqueCustomers", "TotalSales", "AvgItemPrice", "AvgShippingCost", "AvgDeliveryTime", "DelayedOrders", "DelayRate", "AvgOrderValue"]
    want, got = M.mart(df, ["PaymentType"], measures), M.mart(M.marked(df, [("PaymentType",)]), ["PaymentType"], measures)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 3


def test_the_fact_of_the_roles_is_joined_once(spark, sf_dir, monkeypatch):
    from tallymart import catalog

    plans, real = [], H.hot_keys

    def spied(fact, *more):
        plans.append(plan(fact))
        return real(fact, *more)

    monkeypatch.setattr(H, "hot_keys", spied)
    catalog.six_roles(spark, sf_dir)
    assert len(plans) == 5 and not any("Join" in p for p in plans)
