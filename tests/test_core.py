"""Golden run over nine small files, quality, history and replay scenarios, sinks, and the driver contract."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallymart.contracts import SchemaMismatch, assert_schema, contract, spark_type
from tallymart.functions import parsing
from tallymart.operators import history as H, identity as I, marts as M, publish as P, quality as Q, replay as R, star as S
from tallymart.plans import market
from tallymart.sources import files, sinks

BATCH = "2018-04-01 00:00:00"
#: The golden input, one text a file.
FIXTURES = {
    "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\nc1,u1,1000,sao_paulo,SP\nc2,u2,2000,rio_de_janeiro,RJ\nc2,u2,2000,rio_de_janeiro,RJ\nc3,u3,3000,belo_horizonte,MG\n",
    "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\no1,c1,delivered,2018-01-01 10:00:00,2018-01-01 10:30:00,2018-01-02 09:00:00,2018-01-05 12:00:00,2018-01-06 00:00:00\no2,c2,delivered,2018-02-01 09:00:00,2018-02-01 10:00:00,2018-02-02 08:00:00,2018-02-08 15:00:00,2018-02-05 00:00:00\no3,c3,shipped,2018-03-01 08:00:00,2018-03-01 09:00:00,2018-03-02 08:00:00,,2018-03-10 00:00:00\n",
    "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\no1,1,p1,s1,2018-01-02 00:00:00,80.00,10.00\no1,2,p2,s2,2018-01-02 00:00:00,40.00,5.00\no1,2,p2,s2,2018-01-02 00:00:00,40.00,5.00\no2,1,p3,s1,2018-02-02 00:00:00,200.00,20.00\nmissing-order,1,p1,s1,2018-04-02 00:00:00,10.00,2.00\n",
    "order_payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,2,voucher,1,20.00\no1,1,credit_card,2,100.00\no2,1,boleto,1,220.00\no3,1,credit_card,1,50.00\n",
    "order_reviews": "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\nr1,o1,5,Great,Loved it,2018-01-06 00:00:00,2018-01-07 00:00:00\nr2,o2,2,,,2018-02-09 00:00:00,2018-02-12 00:00:00\nr-invalid,missing-order,6,Invalid,Orphan review,2018-04-03 00:00:00,2018-04-04 00:00:00\n",
    "products": "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\np1,livros,10,100,1,500,10,5,5\np2,,20,200,2,,,,\np3,moveis,30,300,3,9000,30,20,15\n",
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1000,sao_paulo,SP\ns2,2000,rio_de_janeiro,RJ\n",
    "geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n1000,-23.5500,-46.6300,sao_paulo,SP\n1000,-23.5510,-46.6310,sao_paulo,SP\n2000,-22.9000,-43.2000,rio_de_janeiro,RJ\n3000,-19.9200,-43.9400,belo_horizonte,MG\n",
    "category_translation": "product_category_name,product_category_name_english\nlivros,books\nmoveis,furniture\n",
}
#: Record hashes of the golden facts.
SALES_HASHES = {("o1", 1): "91f85fb52d5331f88f87411519ac752ebb1acbb737c1098d8327456cf3224e3e", ("o1", 2): "9e8e864365f359446770f0952648cf689058410cdf0017c8417920b8ddf5a2db", ("o2", 1): "4aa190b104bdb7be954a2a59c35b29db6c76fa8f1040946dc985c78c0f5a808b"}
REVIEW_HASHES = {"r1": "4f75428a5feda2823ebe3a789643cfd078d3e17df6bad752fac5cbe7ffa641c6", "r2": "2bbf5f73daaaba85d53c3c666ab06edcd6c248072ac320627d386f927eece727"}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    for name, text in FIXTURES.items():
        (path / market.FILES[name]).write_text(text)
    return str(path)


@pytest.fixture(scope="module")
def golden(spark, folder):
    raw = market.read_all(spark, folder)
    flagged = {n: df.cache() for n, df in market.cleansed(raw).items()}
    return raw, flagged, market.curated(market.accepted(flagged), BATCH)


def test_golden_rows_and_reasons(golden):
    raw, flagged, _ = golden
    assert {n: (df.count(), flagged[n].count()) for n, df in raw.items() if df.count() != flagged[n].count()} == {"customers": (4, 3), "order_items": (5, 4)}
    reasons = {n: {r.reason: r.n_rows for r in Q.reason_counts(Q.split_rows(df)[1]).collect()} for n, df in flagged.items()}
    assert {n: r for n, r in reasons.items() if r} == {"order_items": {"orphan_reference": 1}, "order_reviews": {"orphan_reference": 1, "invalid_review_score": 1}}
    summary = {r.dataset: r for r in Q.quality_summary(flagged).collect()}
    assert summary["order_items"].outcome == "PASSED_WITH_REJECTIONS" and summary["orders"].outcome == "PASSED" and all(r.input_rows == r.valid_rows + r.rejected_rows for r in summary.values())
    assert Q.overall_status(Q.violations(flagged, {n: c.key for n, c in market.RAW.items()})).first()[0] == "accepted-with-rejections"


def test_golden_facts_and_hashes(golden):
    _, _, out = golden
    sales = I.with_record_hash(parsing.project_contract(out["fact_sales"], market.FACT_SALES), market.FACT_SALES)
    assert {(r.OrderID, r.OrderItemID): r.RecordHash for r in sales.collect()} == SALES_HASHES
    reviews = I.with_record_hash(parsing.project_contract(out["fact_reviews"], market.FACT_REVIEWS), market.FACT_REVIEWS)
    assert {r.ReviewID: r.RecordHash for r in reviews.collect()} == REVIEW_HASHES
    assert I.verify_record_hash(sales, market.FACT_SALES).count() == 0 and I.verify_record_hash(sales.withColumn("Price", F.lit(1).cast("decimal(38,18)")), market.FACT_SALES).count() == 3
    m = M.metrics_summary(out["fact_sales"]).first()
    assert (m.sales_rows, m.orders, m.same_state, m.cross_state, m.delayed, float(m.gross_value)) == (3, 2, 1, 2, 1, 355.0)
    assert Q.content_violations(sales, market.FACT_SALES).count() == 0 and Q.grain_violations(sales, market.FACT_SALES.grain).count() == 0


def test_golden_dimensions_and_marts(golden):
    _, _, out = golden
    assert {n: out[n].count() for n in out if n.startswith("dim_")} == {"dim_customer": 3, "dim_product": 3, "dim_seller": 2, "dim_geography": 3, "dim_date": 69, "dim_order_status": 6}
    rows = lambda n, *c: sorted(tuple(float(v) if hasattr(v, "as_tuple") else v for v in r) for r in out[n].select(*c).collect())
    assert rows("sales_by_state", "CustomerState", "OrdersCount", "UniqueCustomers", "TotalSales", "AvgItemPrice", "AvgDeliveryTime") == [("RJ", 1, 1, 200.0, 200.0, 7.0), ("SP", 1, 1, 120.0, 60.0, 4.0)]
    assert rows("monthly_sales", "Year", "Month", "TotalSales", "AvgItemPrice") == [(2018, 1, 120.0, 60.0), (2018, 2, 200.0, 200.0)]
    assert rows("seller_performance", "SellerID", "SellerState", "OrdersCount", "TotalSales", "AvgShippingCost", "AvgDeliveryTime", "DelayedOrders", "DelayRate") == [("s1", "SP", 2, 280.0, 15.0, 5.5, 1, 0.5), ("s2", "RJ", 1, 40.0, 5.0, 4.0, 0, 0.0)]
    assert rows("size_analysis", "ProductCategoryNameEnglish", "SizeCategory", "TotalSales", "AvgShippingCost") == [("books", "Small", 80.0, 10.0), ("furniture", "Large", 200.0, 20.0), ("uncategorized", "Unknown", 40.0, 5.0)]
    assert rows("payment_methods", "PaymentType", "OrdersCount", "TotalSales", "AvgOrderValue", "UniqueCustomers") == [("boleto", 1, 200.0, 200.0, 1), ("credit_card", 1, 120.0, 120.0, 1)]
    assert rows("cross_state_analysis", "ProductCategoryNameEnglish", "IsCrossState", "TotalSales", "DelayRate") == [("books", False, 80.0, 0.0), ("furniture", True, 200.0, 1.0), ("uncategorized", True, 40.0, 0.0)]
    assert rows("sales_by_category", "ProductCategoryNameEnglish", "DelayedOrders", "AvgItemPrice") == [("books", 0, 80.0), ("furniture", 1, 200.0), ("uncategorized", 0, 40.0)]
    assert rows("order_status", "ProductCategoryNameEnglish", "OrderStatus", "OrdersCount", "UniqueCustomers") == [(c, "DELIVERED", 1, 1) for c in ("books", "furniture", "uncategorized")]
    checked = {n: out[n] for n in ("sales_by_state", "sales_by_category", "payment_methods", "size_analysis")}
    assert M.reconcile_totals(out["fact_sales"], checked).filter("NOT matches").count() == 0
    assert P.verify_published(checked, checked).count() == 0


def test_contracts(spark, folder):
    assert spark_type("decimal(10,2)").simpleString() == "decimal(10,2)" and spark_type("decimal").simpleString() == "decimal(38,18)"
    with pytest.raises(ValueError):
        spark_type("float")
    c = contract("x", "a>b string, n decimal(10,2)?", "b")
    assert c.names == ["b", "n"] and c.raw_schema().names == ["a", "n"] and c.schema()["n"].nullable
    df = spark.createDataFrame([("x", 1)], "b string, n int")
    with pytest.raises(SchemaMismatch):
        assert_schema(df, c)
    assert_schema(df.select("b", F.col("n").cast("decimal(10,2)")), c)
    with pytest.raises(files.MissingColumn):
        files.read_contract_csv(spark, f"{folder}/{market.FILES['sellers']}", market.RAW["customers"])
    assert dict(files.read_inferred_csv(spark, f"{folder}/{market.FILES['order_items']}").dtypes)["price"] == "double"


def test_null_conditions_reject_nothing(spark):
    df = spark.createDataFrame([(None, 1), (-1, None), (5, 9)], "a int, b int")
    valid, rejected = Q.reject_rows(df, [Q.not_negative(["a"]), Q.in_order([("a", "b")]), Q.in_range({"b": (2, None)})])
    assert [(r.a, r.rejection_codes) for r in rejected.collect()] == [(None, ["invalid_range"]), (-1, ["invalid_monetary_value"])] and valid.count() == 1
    assert rejected.columns[-1] == "rejection_descriptions" and valid.columns == ["a", "b"]


# History.

HISTORY = "k string, v string, hash string, effective timestamp, expiration timestamp, is_current boolean"


def apply(spark, history, rows):
    snapshot = spark.createDataFrame([(k, v, v, datetime.fromisoformat(t)) for k, v, t in rows], "k string, v string, hash string, at timestamp")
    return spark.createDataFrame(H.scd2_apply(history, snapshot, ["k"], "hash", "at").select(*history.columns).collect(), HISTORY)


def spans(history):
    return [(r.k, r.v, r.effective.isoformat()[:10], r.expiration and r.expiration.isoformat()[:10]) for r in history.orderBy("k", "effective").collect()]


def test_history_scenarios(spark):
    h = apply(spark, spark.createDataFrame([], HISTORY), [("p1", "a", "2024-01-01"), ("q", "x", "2024-01-01")])
    assert spans(h) == [("p1", "a", "1900-01-01", None), ("q", "x", "1900-01-01", None)]
    assert spans(apply(spark, h, [("p1", "a", "2024-03-01")])) == spans(h)
    h = apply(spark, h, [("p1", "b", "2024-04-01")])
    assert spans(h)[:2] == [("p1", "a", "1900-01-01", "2024-04-01"), ("p1", "b", "2024-04-01", None)] and h.filter("is_current AND k = 'p1'").count() == 1
    h = apply(spark, h, [("p1", "b", "2024-05-01")])
    h = apply(spark, h, [("p1", "late", "2024-03-15")])
    assert spans(h)[:3] == [("p1", "a", "1900-01-01", "2024-03-15"), ("p1", "late", "2024-03-15", "2024-04-01"), ("p1", "b", "2024-04-01", None)]
    assert spans(apply(spark, h, [("p1", "late", "2024-03-15")])) == spans(h)
    clash = spark.createDataFrame([("p1", "other", datetime(2024, 3, 15)), ("q", "y", datetime(2024, 3, 15)), ("q", "z", datetime(2024, 3, 16))], "k string, hash string, at timestamp")
    assert sorted((r.k, r.reason) for r in H.scd2_conflicts(h, clash, ["k"], "hash", "at").collect()) == [("p1", "same_time_other_content"), ("q", "duplicate_key")]
    keyed = h.withColumn("sk", F.xxhash64("k", "effective"))
    assert H.scd2_integrity(keyed, ["k"], "sk").count() == 0
    events = spark.createDataFrame([(1, "p1", datetime(2024, 3, 20)), (2, "nobody", datetime(2024, 4, 15))], "id int, k string, at timestamp")
    resolved, bad = H.resolve_event_time(events, keyed, ["id"], ["k"], "at", "sk")
    assert [(r.id, r.matches) for r in bad.collect()] == [(2, 0)]
    _, twice = H.resolve_event_time(events, keyed.unionByName(keyed.withColumn("sk", F.col("sk") + 1)), ["id"], ["k"], "at", "sk")
    assert sorted((r.id, r.matches) for r in twice.collect()) == [(1, 2), (2, 0)]


def test_backfill_equals_batches_in_order(spark):
    rng, rows = random.Random(1), []
    for k in "abcd":
        for day in sorted(rng.sample(range(1, 28), 8)):
            rows.append((k, rng.choice("xyz"), f"2024-01-{day:02d}"))
    snapshots = spark.createDataFrame([(k, v, v, datetime.fromisoformat(t)) for k, v, t in rows], "k string, v string, hash string, at timestamp")
    h = spark.createDataFrame([], HISTORY)
    for day in sorted({t for *_, t in rows}):
        h = apply(spark, h, [r for r in rows if r[2] == day])
    assert spans(H.scd2_backfill(snapshots, ["k"], "at", "hash")) == spans(h)


# Replay.


def test_replay_scenarios(spark):
    good, other = "a" * 64, "b" * 64
    a = lambda ds, b, n, status, retry=None, sha=good, outcome="new-content", reused=None: (ds, b, n, f"{ds}{b}{n}", datetime(2024, 1, n), "t", "f", sha, status, retry, outcome, reused)
    audit = spark.createDataFrame(
        [a("d1", "b1", 1, "SUCCEEDED"), a("d2", "b1", 1, "FAILED", True), a("d3", "b1", 1, "FAILED", False), a("d4", "b1", 1, "FAILED"), a("d4", "b1", 1, "FAILED"), a("d5", "b1", 1, "SKIPPED", None, good, "no-op", "old"), a("d6", "b1", 1, "FAILED"), a("d7", "b1", 2, "FAILED")],
        "dataset string, batch_id string, attempt_number int, submission_id string, submitted_at timestamp, batch_timestamp string, source_file_id string, content_sha256 string, terminal_status string, retryable boolean, replay_outcome string, reused_submission_id string",
    )
    m = lambda ds, b, sha=good, f="f": (b, "t", ds, f, sha)
    asked = [m("new", "b1"), m("d1", "b2", other), m("d1", "b3"), m("d1", "b1"), m("d5", "b1"), m("d2", "b1"), m("d3", "b1"), m("d6", "b1"), m("d1", "b1", good, "moved"), m("d4", "b1"), m("d7", "b1"), m("d1", "b9", "A" * 64), m("d1", "b9", None), m("d1", "b9", good, " ")]
    manifests = spark.createDataFrame(asked, "batch_id string, batch_timestamp string, dataset string, source_file_id string, content_sha256 string")
    got = {(r.dataset, r.batch_id, r.content_sha256, r.source_file_id): (r.decision, r.reused_submission_id) for r in R.replay_decisions(manifests, audit).collect()}
    want = [("initial-load", None), ("new-content", None), ("no-op", "d1b11"), ("no-op", "d1b11"), ("no-op", "old"), ("retry", None), ("reused-failure", "d3b11"), ("reused-failure", "d6b11")] + [("fail-batch", None)] * 6
    assert [got[(ds, b, sha, f)] for b, _, ds, f, sha in asked] == want
    decided = spark.createDataFrame([("b", "x", "retry"), ("b", "y", "fail-batch"), ("b", "z", "no-op"), ("c", "x", "retry")], "batch_id string, dataset string, decision string")
    assert sorted((r.batch_id, r.dataset, r.decision) for r in R.abort_batch(decided).collect()) == [("b", "x", "fail-batch"), ("b", "y", "fail-batch"), ("b", "z", "no-op"), ("c", "x", "retry")]


# Sources, sinks and publication.


def test_files_and_layers(spark, folder, golden, tmp_path):
    _, _, out = golden
    got = {r.name: r.status for r in files.source_inventory(spark, folder, [market.FILES["orders"], market.FILES["sellers"].upper(), "absent.csv"]).collect()}
    assert got[market.FILES["orders"]] == "accepted" and got[market.FILES["sellers"]] == "case-ambiguous" and got["absent.csv"] == "missing" and got[market.FILES["products"]] == "unexpected"
    manifest = {r.source_file_id: r for r in files.file_manifests(spark, folder, "b1", BATCH).collect()}
    import hashlib

    assert manifest[market.FILES["sellers"]].content_sha256 == hashlib.sha256(FIXTURES["sellers"].encode()).hexdigest() and len(manifest) == 9
    tables = {n: out[n] for n in ("dim_seller", "sales_by_state")}
    marker = sinks.publish_batch(tables, str(tmp_path / "curated"), "b1")
    sinks.publish_batch({n: df.limit(1) for n, df in tables.items()}, str(tmp_path / "curated"), "b2")
    sinks.publish_batch(tables, str(tmp_path / "curated"), "b1")
    back = files.read_layer(spark, str(tmp_path / "curated/dim_seller")).filter("batch_id = 'b1'")
    assert P.diff(out["dim_seller"], back.drop("batch_id")).count() == 0 and {r.dataset: r.n_rows for r in marker.collect()} == {"dim_seller": 2, "sales_by_state": 2}
    assert P.verify_summary(marker.select("dataset", "n_rows"), tables).count() == 0
    sinks.write_csv_export(out["sales_by_state"], str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    sinks.write_layer(out["dim_seller"], str(tmp_path / "layer/sellers"))
    sinks.register_tables(spark, [contract("sellers", "SellerID string, SellerCity string")], str(tmp_path / "layer"))
    assert spark.table("sellers").count() == 2
    spark.sql("DROP TABLE sellers")
    staged = sinks.stage_for_history(out["dim_seller"], contract("s", "SellerID string, SellerCity string", tracked="SellerCity"), "a1", "b1", BATCH)
    assert staged.columns == ["SellerID", "SellerCity", "TrackedHash", "AttemptID", "BatchID", "EffectiveAt"]


def test_jdbc_round_trip(spark):
    options = {"url": "jdbc:derby:memory:tally;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(1, "x"), (2, "y")], "ID int, NAME string")
    assert sinks.append_jdbc(df, options, "T1", "a1").count() == 2
    assert sinks.append_jdbc(df.limit(1), options, "T1", "a2").count() == 1
    assert files.read_jdbc(spark, options, 'SELECT "ID" FROM T1').count() == 3
    assert sorted(r.ID for r in files.read_jdbc(spark, options, 'SELECT "ID" FROM T1', ("ID", 0, 10, 3)).collect()) == sorted(r.ID for r in files.read_jdbc(spark, options, 'SELECT "ID" FROM T1').collect())


def test_keys_publication_and_fingerprints(spark):
    new = spark.range(1000).selectExpr("id * 7 % 1000 AS k", "id AS v").repartition(7)
    keys = [r.sk for r in S.allocate_keys(new, spark.createDataFrame([(5,)], "sk long"), "k", "sk").orderBy("k").collect()]
    assert keys == list(range(6, 1006))
    target = spark.createDataFrame([("a", 1), ("gone", 2)], "k string, sk long")
    assert {r.k: r.sk for r in P.publish_snapshot(target, spark.createDataFrame([("a", 0), ("b", 0)], "k string, v int"), "k", "sk").collect()} == {"a": 1, "b": 3}
    assert I.table_fingerprint(new).first() == I.table_fingerprint(new.repartition(3, "v").orderBy("v")).first() != I.table_fingerprint(new.withColumn("v", F.col("v") + 1)).first()
    decisions = spark.createDataFrame([("a", "PUBLISH"), ("b", "NO_OP"), ("c", "ERROR")], "batch_id string, decision string")
    assert sorted((r.batch_id, r.event) for r in P.publication_events(decisions, BATCH).collect()) == [("a", "COMPLETED"), ("a", "STARTED"), ("b", "NO_OP"), ("c", "FAILED")]


def test_driver_contract(spark, sf_dir):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names)
    for name in ("a1_sales_by_category", "d7_fact_sales", "h1_scd2_backfill", "r1_replay_decisions"):
        plan = names[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan
    scan = names["a2_sales_by_state"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "l_quantity" not in scan and "l_returnflag" not in scan


def test_shipping_days_start_at_approval(spark):
    at = lambda d: datetime(2018, 1, d, 8)
    rows = [(1, "shipped", at(1), at(4), at(9), None, at(20)), (2, "created", at(1), None, at(9), None, at(20))]
    names = "order_id order_status order_purchase_timestamp order_approved_at order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n == 'order_id' else 'string' if n == 'order_status' else 'timestamp'}" for n in names.split()))
    assert {r.order_id: (r.shipping_time_days, r.shipping_days) for r in market.with_order_columns(df).collect()} == {1: (5, 5), 2: (None, -1)}


def test_allocated_keys_are_dense_with_wide_rows(spark):
    """More rows than a range exchange samples, several columns, in two layouts."""
    rows = spark.range(150_000).selectExpr("(id * 7919) % 150000 AS k", "id AS other", "repeat('x', CAST(id % 50 AS INT)) AS text")
    for df in (rows, rows.repartition(7)):
        got = S.allocate_keys(df, spark.range(1).selectExpr("500L AS sk"), "k", "sk")
        assert got.columns == ["k", "other", "text", "sk"]
        assert got.selectExpr("count(*)", "count(DISTINCT sk)", "count_if(sk <> k + 501)").first()[:] == (150_000, 150_000, 0)


def test_deduplicate_by_key(spark):
    rows = spark.createDataFrame([(1, "a", " a"), (1, "a", "a"), (2, None, ""), (2, None, ""), (None, "c", "c"), (3, "d", "d")], "k int, v string, _raw__v string")
    kept, removed = Q.deduplicate(rows, ["k"])
    assert removed == 2 and sorted((r.k or 0, r.v or "") for r in kept.collect()) == [(0, "c"), (1, "a"), (2, ""), (3, "d")] and kept.columns == rows.columns
    with pytest.raises(Q.ConflictingKeys):
        Q.deduplicate(rows.withColumn("v", F.col("_raw__v")), ["k"])
    assert Q.deduplicate(rows.limit(0), ["k"])[1] == 0


def test_processed_rules(golden, spark):
    _, flagged, _ = golden
    frames = market.accepted(flagged)
    clean = {n: df.filter(F.size("rejection_codes") > 0).count() for n, df in market.validated(frames).items()}
    assert set(clean.values()) == {0}
    broken = {**frames, "orders": frames["orders"].withColumn("order_month", F.when(F.col("order_id") == "o1", 13).otherwise(F.col("order_month"))), "products": frames["products"].withColumn("product_photos_qty", F.lit(-1)), "sellers": frames["sellers"].withColumn("seller_city", F.lit(None).cast("string"))}
    found = market.validated(broken)
    reasons = {n: {r.reason: r.n_rows for r in Q.reason_counts(df).collect()} for n, df in found.items()}
    assert reasons["orders"] == {"invalid_range": 1} and reasons["products"] == {"invalid_range": 3} and reasons["sellers"] == {"required_key_null": 2}
    assert reasons["order_items"] == {"orphan_reference": frames["order_items"].count()} and reasons["customers"] == {}
    assert found["orders"].filter("order_id = 'o1'").first().rejection_descriptions == ["A numeric value is outside its valid range."]


def test_tables_go_with_their_scope(spark):
    from tallymart import tables

    with tables.scratch(spark):
        path = tables.new_path(spark, "x")
        assert tables.written(spark.range(3).toDF("n"), "x").count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path.rpartition("/")[0])
    assert tables.unused("_id", spark.range(1).toDF("_ID")) == "_id_"
