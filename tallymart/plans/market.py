"""A marketplace's nine CSV files as contracts, rules and the star they end in."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tallymart.contracts import Contract, contract
from tallymart.functions.derive import with_order_columns
from tallymart.functions import parsing
from tallymart.functions.parsing import normalize, project_contract
from tallymart.operators import marts, quality as Q, star
from tallymart.sources import publication
from tallymart.sources.files import read_contract_csv
from tallymart.tables import written

RAW = {
    c.name: c
    for c in (
        contract("customers", "customer_id string, customer_unique_id string, customer_zip_code_prefix integer, customer_city string, customer_state string", "customer_id"),
        contract("orders", "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, order_approved_at timestamp?, order_delivered_carrier_date timestamp?, order_delivered_customer_date timestamp?, order_estimated_delivery_date timestamp?", "order_id"),
        contract("order_items", "order_id string, order_item_id integer, product_id string, seller_id string, shipping_limit_date timestamp, price decimal(10,2), freight_value decimal(10,2)", "order_id order_item_id"),
        contract("order_payments", "order_id string, payment_sequential integer, payment_type string, payment_installments integer, payment_value decimal(10,2)", "order_id payment_sequential"),
        contract("order_reviews", "review_id string, order_id string, review_score integer, review_comment_title string?, review_comment_message string?, review_creation_date timestamp, review_answer_timestamp timestamp", "review_id order_id"),
        contract("products", "product_id string, product_category_name string?, product_name_lenght>product_name_length integer?, product_description_lenght>product_description_length integer?, product_photos_qty integer?, product_weight_g decimal?, product_length_cm decimal?, product_height_cm decimal?, product_width_cm decimal?", "product_id"),
        contract("sellers", "seller_id string, seller_zip_code_prefix integer, seller_city string, seller_state string", "seller_id"),
        contract("geolocation", "geolocation_zip_code_prefix integer, geolocation_lat decimal, geolocation_lng decimal, geolocation_city string, geolocation_state string", "geolocation_zip_code_prefix geolocation_lat geolocation_lng"),
        contract("category_translation", "product_category_name string, product_category_name_english string", "product_category_name"),
    )
}
FILES = {**{n: f"olist_{n}_dataset.csv" for n in RAW if n != "category_translation"}, "category_translation": "product_category_name_translation.csv"}

FACT_SALES = contract(
    "fact_sales",
    "OrderID string, OrderItemID integer, CustomerID string, ProductID string, SellerID string, DateKey integer, StatusID string, ZipCodePrefix integer, OrderPurchaseTimestamp timestamp, OrderDeliveredCustomerDate timestamp?, Price decimal, FreightValue decimal, TotalItemValue decimal, ShippingDays integer?, DeliveryDays integer?, TotalDays integer?, IsDelayed boolean, DelayDays integer, IsCrossState boolean, PaymentType string?",
    "OrderID OrderItemID",
)
FACT_REVIEWS = contract("fact_reviews", "OrderID string, ReviewID string, CustomerID string, DateKey integer, ReviewScore integer, ReviewCommentMessage string?, ReviewCreationDate timestamp, ReviewAnswerTimestamp timestamp, ReviewResponseDays integer", "OrderID ReviewID")

REFERENCES = [
    Q.Reference("orders", ("customer_id",), "customers", ("customer_id",)),
    Q.Reference("order_items", ("order_id",), "orders", ("order_id",)),
    Q.Reference("order_items", ("product_id",), "products", ("product_id",)),
    Q.Reference("order_items", ("seller_id",), "sellers", ("seller_id",)),
    Q.Reference("order_payments", ("order_id",), "orders", ("order_id",)),
    Q.Reference("order_reviews", ("order_id",), "orders", ("order_id",)),
]


#: Numbers of a product that must not be negative.
SIZES = ["product_name_length", "product_description_length", "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


def business_rules(name: str) -> list[Q.Rule]:
    """Rules on the typed columns of a dataset, at both stages."""
    return {
        "orders": [Q.in_order([("order_purchase_timestamp", "order_approved_at"), ("order_approved_at", "order_delivered_carrier_date"), ("order_delivered_carrier_date", "order_delivered_customer_date")])],
        "order_items": [Q.not_negative(["price", "freight_value"], {"order_item_id": 1})],
        "order_payments": [Q.not_negative(["payment_value"]), Q.in_range({"payment_sequential": (1, None), "payment_installments": (0, None)})],
        "order_reviews": [Q.score_between("review_score"), Q.in_order([("review_creation_date", "review_answer_timestamp")])],
        "products": [Q.in_range({k: (0, None) for k in SIZES})],
        "geolocation": [Q.in_range({"geolocation_lat": (-90, 90), "geolocation_lng": (-180, 180)})],
    }.get(name, [])


def rules(name: str) -> list[Q.Rule]:
    """Raw-stage rules of a dataset, over its typed and raw columns."""
    c = RAW[name]
    return [Q.required(c.key), Q.unparsed(c), *business_rules(name)]


def processed_rules(name: str) -> list[Q.Rule]:
    """Rules of a processed dataset: every field that is not nullable, the business rules, and what is derived."""
    derived = {"orders": ["order_year", "order_month", "order_day"], "products": ["product_category_name", "product_category_name_english"]}.get(name, [])
    of_dates = [Q.in_range({"order_month": (1, 12), "order_day": (1, 31)})] if name == "orders" else []
    return [Q.required([f.name for f in RAW[name].fields if not f.nullable] + derived), *business_rules(name), *of_dates]


def read_all(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {n: read_contract_csv(spark, f"{folder}/{FILES[n]}", c) for n, c in RAW.items()}


def grain_code(name: str) -> str:
    return "duplicate_fact_grain" if name in ("order_items", "order_reviews") else "conflicting_business_key"


def cleansed(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every dataset typed, with reasons from row, key and reference rules.

    The row rules come first: a rejected row stays as often as it stands. Accepted rows that are equal once typed become one (copies
    says how many there were); accepted rows of one key that still differ are in conflict.
    """
    flagged = {}
    for name, df in raw.items():
        rows = written(Q.drop_repeated_accepted(Q.with_reasons(normalize(df, RAW[name]), rules(name))), "rows")
        flagged[name] = Q.flag_duplicate_keys(rows, RAW[name].key, grain_code(name), among=F.size("rejection_codes") == 0)
    return Q.cascade_references(flagged, REFERENCES)


def accepted(flagged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Processed frames: accepted rows in contract columns, orders and products with what is derived."""
    frames = {n: project_contract(Q.split_rows(df)[0], RAW[n]) for n, df in flagged.items()}
    frames["orders"] = with_order_columns(frames["orders"])
    frames["products"] = star.translate(frames["products"], frames["category_translation"], "product_category_name", "product_category_name_english", "uncategorized").fillna({"product_category_name": "uncategorized"})
    return frames


def validated(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Processed frames with reasons from the processed rules, keys and references."""
    flagged = {}
    for name, df in frames.items():
        flagged[name] = Q.flag_duplicate_keys(Q.with_reasons(df, processed_rules(name)), RAW[name].key, grain_code(name))
    return Q.cascade_references(flagged, REFERENCES)


def curated(frames: Mapping[str, DataFrame], batch: str) -> dict[str, DataFrame]:
    """Dimensions, facts and the eight marts."""
    sales = star.fact_sales(frames)
    out = {
        "dim_customer": star.dim_customer(frames["customers"], batch), "dim_product": star.dim_product(frames["products"], batch), "dim_seller": star.dim_seller(frames["sellers"], batch),
        "dim_geography": star.dim_geography(frames["geolocation"], batch), "dim_date": star.dim_date(star.date_bounds(frames["orders"])), "dim_order_status": star.dim_order_status(sales.sparkSession),
        "fact_sales": sales, "fact_reviews": star.fact_reviews(frames),
    }
    return {**out, **marts.all_marts(star.enriched_sales(frames, out), sales)}


def process(spark: SparkSession, folder: str, root: str, batch_id: str, at: str, identity: Mapping[str, object] | None = None) -> dict:
    """Read, cleanse and publish the processed and the rejected rows of all datasets; the terminal summary.

    Source rows are counted by the tasks that read them and published rows by those that write them. Raises NotReconciled, before
    anything is published, where source rows are not rejected + processed + repeated ones.
    """
    seen = {n: Observation() for n in RAW}
    flagged = cleansed({n: df.observe(seen[n], F.count(F.lit(1)).alias("n")) for n, df in read_all(spark, folder).items()})
    source = spark.createDataFrame([(n, seen[n].get["n"]) for n in flagged], "dataset string, source_rows long")
    counts = source.join(Q.three_way_counts(flagged), "dataset").collect()  # a row for each dataset
    if wrong := [r for r in counts if r.source_rows != r.rejected_rows + r.processed_rows + r.duplicate_rows]:
        raise NotReconciled(str(wrong))
    outcome = "PASSED_WITH_REJECTIONS" if any(r.rejected_rows for r in counts) else "PASSED"
    raw = {n: [f.source_name for f in c.fields] for n, c in RAW.items()}
    rejected = {n: Q.split_rows(df)[1].select(*[F.col(parsing.RAW + f.name).alias(s) for f, s in zip(RAW[n].fields, raw[n], strict=True)], "rejection_codes", "rejection_descriptions") for n, df in flagged.items()}
    frames = {f"processed_{n}": df for n, df in accepted(flagged).items()} | {f"rejected_{n}": df for n, df in rejected.items()}
    expected = {f"{kind}_{r.dataset}": r[f"{kind}_rows"] for r in counts for kind in ("processed", "rejected")}
    publication.publish(frames, root, batch_id, at, expected)
    columns = ("source_rows", "processed_rows", "rejected_rows", "duplicate_rows")
    summary = publication.terminal_summary(spark, root, batch_id, identity or {}, outcome)
    return summary | {"datasets": {r.dataset: {c: r[c] for c in columns} for r in counts}, "totals": {c: sum(r[c] for r in counts) for c in columns}}


class NotReconciled(ValueError):
    """Rows were lost or made between reading and publishing."""
