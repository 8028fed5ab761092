"""Publications: two phases, markers, registry under concurrent attempts, catalog tables."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tallymart.sources import publication as P

AT = "2018-04-01 00:00:00"


def numbers(spark, n, word):
    return spark.range(n).select("id", F.lit(word).alias("word"))


def seen(spark, root, name="t"):
    return sorted((r.batch_id, r.id, r.word) for r in P.read_published(spark, root, name).collect())


def test_a_failure_leaves_the_state_before(spark, tmp_path):
    root = str(tmp_path / "p")
    P.publish({"s": numbers(spark, 3, "old"), "t": numbers(spark, 2, "old")}, root, "b1", AT)
    broken = numbers(spark, 4, "new").withColumn("word", F.when(F.col("id") == 3, F.raise_error(F.lit("provoked"))).otherwise(F.col("word")))
    with pytest.raises(Exception, match="provoked"):
        P.publish({"s": numbers(spark, 9, "new"), "t": broken}, root, "b1", AT)
    assert seen(spark, root, "s") == [("b1", i, "old") for i in range(3)] and seen(spark, root) == [("b1", 0, "old"), ("b1", 1, "old")]
    assert len(P.children(spark, f"{root}/s/batch_id=b1")) == 1
    with pytest.raises(P.NotVerified, match="'t', 5, 6"):
        P.publish({"t": numbers(spark, 5, "new")}, root, "b1", AT, expected={"t": 6})
    lines = [{"dataset": "t", "batch_id": "b1", "version": P.published(spark, root).filter("dataset = 't'").first().version, "n_rows": 7, "fields": numbers(spark, 1, "x").schema.json()}]
    with pytest.raises(P.NotVerified):
        P.verify_staged(spark, root, lines)


def test_batches_are_replaced_whole_and_pruned(spark, tmp_path):
    root = str(tmp_path / "p")
    odd = "2018/04=01 é"
    P.publish({"t": numbers(spark, 2, "a"), "u": numbers(spark, 0, "")}, root, odd, AT)
    P.publish({"t": numbers(spark, 1, "b").withColumn("more", F.lit(1.5))}, root, "b2", "2018-04-02 00:00:00")
    P.publish({"t": numbers(spark, 3, "c"), "u": numbers(spark, 0, "")}, root, odd, AT)
    assert seen(spark, root) == [(odd, 0, "c"), (odd, 1, "c"), (odd, 2, "c"), ("b2", 0, "b")]
    assert P.read_published(spark, root, "u").count() == 0 and P.read_published(spark, root, "u").columns == ["id", "word", "batch_id"]
    assert sorted((r.batch_id, r.more) for r in P.read_published(spark, root, "t").select("batch_id", "more").distinct().collect()) == [(odd, None), ("b2", 1.5)]
    one = P.read_published(spark, root, "t").filter("batch_id = 'b2'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and one.count() == 1
    assert P.remove_unnamed(spark, root, ["t", "u"], 0) == 0 and P.remove_unnamed(spark, root, ["t", "u"], 2**62) == 2
    assert seen(spark, root) == [(odd, 0, "c"), (odd, 1, "c"), (odd, 2, "c"), ("b2", 0, "b")]
    with pytest.raises(ValueError, match="not been published"):
        P.read_published(spark, root, "absent")


@pytest.mark.parametrize("prints", [("f", "f", "f", "f"), ("f", "g", "h", "i")])
def test_one_of_many_attempts_registers(spark, tmp_path, prints):
    root = str(tmp_path / "p")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda x: P.publish_once({"t": numbers(spark, 5, str(x[0]))}, root, "b", x[1], AT, f"a{x[0]}"), enumerate(prints)))
    other = "NO_OP" if len(set(prints)) == 1 else "CONFLICT"
    assert sorted(got) == sorted(["PUBLISHED"] + [other] * 3)
    first = got.index("PUBLISHED")
    assert [tuple(r)[:2] for r in P.registry(spark, root).collect()] == [("b", prints[first])]
    assert seen(spark, root) == [("b", i, str(first)) for i in range(5)]
    assert len(P.children(spark, f"{root}/t/batch_id=b")) == 1
    events = [(r.attempt_id, r.event) for r in P.events(spark, root).collect()]
    assert (f"a{first}", "COMPLETED") in events and sum(e == other for _, e in events) == 3


def test_events_of_a_failed_attempt(spark, tmp_path):
    root = str(tmp_path / "p")
    with pytest.raises(Exception, match="provoked"):
        P.publish_once({"t": spark.range(1).select(F.raise_error(F.lit("provoked")).cast("int").alias("x"))}, root, "b", "f", AT, "a1")
    assert sorted(r.event for r in P.events(spark, root).collect()) == ["FAILED", "STARTED"] and P.registry(spark, root).count() == 0
    assert P.publish_once({"t": numbers(spark, 1, "x")}, root, "b", "f", AT, "a2") == "PUBLISHED"


def test_create_if_absent_by_rename(spark, tmp_path):
    """A file system that is not local: there it is a rename without overwriting."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.tests.link./in", f"file://{tmp_path}")
    path = "viewfs://tests/in/deep/er/marker.json"
    assert P.create_if_absent(spark, path, "one") and not P.create_if_absent(spark, path, "two")
    assert (tmp_path / "deep/er/marker.json").read_text() == "one" and [n for n, _ in P.children(spark, "viewfs://tests/in/deep/er") if n.startswith(".marker")] == []


def test_summary_and_catalog_table(spark, tmp_path):
    root = str(tmp_path / "p")
    money = numbers(spark, 4, "m").withColumn("price", F.expr("CAST(id + 0.25 AS DECIMAL(10,2))"))
    for b in ("b1", "it's"):
        P.publish({"t": money.filter("id > 1") if b == "b1" else money, "empty": numbers(spark, 0, "")}, root, b, AT, totals={"t": ["price"]})
    got = P.terminal_summary(spark, root, "it's", {"contract_version": 1}, "PASSED")
    assert got["row_counts"] == {"empty": 0, "t": 4} and got["totals"] == {"t": {"price": "7.00"}} and got["publication_status"] == "COMPLETED"
    assert spark.read.parquet(got["produced_datasets"]["t"]["prefix"]).count() == 4
    P.register_published(spark, root, "t", "published_t")
    assert spark.table("published_t").groupBy("batch_id").count().orderBy("batch_id").collect() == [("b1", 2), ("it's", 4)]
    P.publish({"t": money.limit(1)}, root, "b1", AT)
    P.register_published(spark, root, "t", "published_t")
    one = spark.table("published_t").filter("batch_id = 'b1'")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(batch_id" in one._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE published_t")
