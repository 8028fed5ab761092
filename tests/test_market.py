"""The marketplace plan: rules before deduplication, counts that reconcile, what is published."""

import pytest
from pyspark.sql import functions as F
from test_core import BATCH, FIXTURES

from tallymart.operators import quality as Q
from tallymart.plans import market
from tallymart.sources import publication


def folder_of(tmp_path, **changed):
    for name, text in {**FIXTURES, **changed}.items():
        (tmp_path / market.FILES[name]).write_text(text)
    return str(tmp_path)


def test_rows_equal_but_for_blanks_are_one_and_bad_rows_stay(spark, tmp_path):
    sellers = FIXTURES["sellers"] + "s1,1000,sao_paulo, SP\ns3,x,nowhere,SP\ns3,x,nowhere,SP\ns4,4000,a,SP\ns4,4000,b,SP\ns4,4000,b,SP \n,5000,c,SP\n,5000,c,SP\n"
    flagged = market.cleansed(market.read_all(spark, folder_of(tmp_path, sellers=sellers)))
    rows = sorted((r.seller_id or "", r.copies, r.rejection_codes) for r in flagged["sellers"].collect())
    assert rows == [("", 1, ["required_key_null"]), ("", 1, ["required_key_null"]), ("s1", 2, []), ("s2", 1, []), ("s3", 1, ["invalid_parse"]), ("s3", 1, ["invalid_parse"]), ("s4", 1, ["conflicting_business_key"]), ("s4", 2, ["conflicting_business_key"])]
    assert {r.rejection_codes[0] for r in flagged["order_items"].filter(F.size("rejection_codes") > 0).collect()} == {"orphan_reference"} and flagged["order_items"].filter(F.size("rejection_codes") == 0).count() == 3
    counts = {r.dataset: tuple(r)[1:] for r in Q.three_way_counts(flagged).collect()}
    assert counts["sellers"] == (6, 2, 2) and counts["customers"] == (0, 3, 1) and counts["order_items"] == (1, 3, 1)


def test_processed_and_rejected_rows_are_published(spark, tmp_path):
    folder, root = folder_of(tmp_path), str(tmp_path / "out")
    summary = market.process(spark, folder, root, "b1", BATCH, {"contract_version": 1})
    assert summary["terminal_outcome"] == "PASSED_WITH_REJECTIONS" and summary["publication_status"] == "COMPLETED" and summary["contract_version"] == 1
    assert summary["datasets"]["order_items"] == {"source_rows": 5, "processed_rows": 3, "rejected_rows": 1, "duplicate_rows": 1}
    assert summary["totals"]["source_rows"] == sum(text.count("\n") - 1 for text in FIXTURES.values())
    assert summary["row_counts"]["processed_sellers"] == 2 and summary["row_counts"]["rejected_sellers"] == 0 and len(summary["produced_datasets"]) == 18
    back = publication.read_published(spark, root, "rejected_order_reviews").first()
    assert back.review_id == "r-invalid" and sorted(back.rejection_codes) == ["invalid_review_score", "orphan_reference"]
    again = market.process(spark, folder, root, "b1", BATCH)
    assert again["row_counts"] == summary["row_counts"] and publication.read_published(spark, root, "processed_orders").count() == 3


def test_lost_rows_stop_the_publication(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "drop_repeated_accepted", lambda df, f=Q.drop_repeated_accepted: f(df.dropDuplicates()))
    with pytest.raises(market.NotReconciled):
        market.process(spark, folder_of(tmp_path), str(tmp_path / "out"), "b1", BATCH)
    assert publication.published(spark, str(tmp_path / "out")).count() == 0


def test_repeated_keys_are_flagged_wherever_they_are(spark):
    rows = spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN 1 WHEN id % 3 = 0 THEN NULL ELSE id END AS k", "id % 5 <> 0 AS counts").repartition(9)
    got = {(r.k, tuple(r.rejection_codes)): r.n for r in Q.flag_duplicate_keys(rows, ["k"], "c").filter("k IS NULL OR k < 12").groupBy("k", "rejection_codes").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, ("c",)): 2001, (None, ("c",)): 667, (5, ()): 1, (7, ()): 1, (11, ()): 1}
    some = Q.flag_duplicate_keys(rows, ["k"], "c", among=F.col("counts"))
    assert some.filter("k = 1 AND counts AND size(rejection_codes) = 0").count() == 0 and some.filter("NOT counts AND size(rejection_codes) > 0").count() == 0
