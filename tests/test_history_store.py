"""Interval joins of hot keys, several roles with their proof, and history of which a batch rewrites what it changes."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallymart.operators import history as H
from tallymart.sources import history_store as S
from tallymart.sources.publication import Conflict

HISTORY = "k string, v string, hash string, effective timestamp, expiration timestamp, is_current boolean"


def test_a_hot_key_is_in_many_tasks(spark, monkeypatch):
    fact = spark.range(20_000).selectExpr("CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 5 = 0 THEN NULL ELSE concat('k', id % 700) END AS k", "timestamp_seconds(CASE WHEN id % 3 = 0 THEN 5000 ELSE id END) AS at", "id").repartition(8)
    history = spark.range(701).selectExpr("CASE WHEN id = 700 THEN 'hot' ELSE concat('k', id) END AS k", "explode(sequence(0, 19000, 500)) AS s").selectExpr("k", "timestamp_seconds(s) AS effective", "CASE WHEN s < 19000 THEN timestamp_seconds(s + CASE WHEN s = 5000 THEN 400 ELSE 500 END) END AS expiration", "concat(k, s) AS sk")
    for how in ("inner", "left"):
        plain = H.interval_join(fact, history, ["k"], "at", how=how)
        spread = H.interval_join_spread(fact, history, ["k"], "at", how=how)
        assert spread.columns == plain.columns and spread.exceptAll(plain).count() == plain.exceptAll(spread).count() == 0
    seen = {}
    monkeypatch.setattr(H, "interval_join", lambda rows, versions, *rest, **more: seen.update(rows=rows, versions=versions) or rows)
    H.interval_join_spread(fact, history, ["k"], "at")
    sizes = {k: [r.n for r in seen["rows"].filter(where).groupBy("_bucket").agg(F.count("*").alias("n")).collect()] for k, where in {"hot": "k = 'hot'", "null": "k IS NULL", "rest": "k LIKE 'k%'"}.items()}
    assert len(sizes["hot"]) > 40 and max(sizes["hot"]) < 1200 and len(sizes["null"]) > 4 and len(sizes["rest"]) == 1
    assert seen["versions"].filter("k <> 'hot'").count() == 700 * 39 and seen["versions"].filter("k = 'hot'").count() <= H.PARTS * (39 + 2 * H.BUCKETS)


def test_buckets_cut_a_hot_key_in_time_and_parts(spark):
    fact = spark.range(9000).selectExpr("1 AS k", "timestamp_seconds(id * id) AS at").repartition(4)
    bounds = H.hot_keys(fact, ["k"], "at").first().bounds
    assert len(bounds) == H.BUCKETS - 1 and bounds == sorted(bounds)
    sizes = [r.n for r in fact.selectExpr(f"size(filter(array({','.join(f'{b}L' for b in bounds)}), b -> b <= unix_micros(at))) AS b").groupBy("b").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == H.BUCKETS and max(sizes) < 2 * 9000 / H.BUCKETS
    assert H.hot_keys(spark.range(5000).selectExpr("id AS k", "timestamp_seconds(id) AS at"), ["k"], "at") is None
    assert H.hot_keys(fact.limit(0), ["k"], "at") is None and H.hot_keys(fact.withColumn("k", F.lit(None).cast("int")), ["k"], "at") is None


def test_roles_chain_and_prove_themselves(spark):
    versions = lambda rows, more="": spark.createDataFrame(rows, f"id string, sk int, effective timestamp, expiration timestamp{more}")
    at = lambda d: f"2018-01-{d:02}"
    fix = lambda df: df.withColumns({c: F.col(c).cast("timestamp") for c in ("effective", "expiration")})
    text = lambda rows, more="": fix(spark.createDataFrame(rows, f"id string, sk int, effective string, expiration string{more}"))
    sellers = text([("s1", 1, "1900-01-01", at(5), "z1"), ("s1", 2, at(5), None, "z2"), ("s2", 3, at(3), None, "z9")], ", zip string")
    zips = text([("z1", 10, "1900-01-01", None), ("z2", 20, "1900-01-01", at(8)), ("z2", 21, at(7), None)])
    fact = spark.createDataFrame([(1, "s1", at(2)), (2, "s1", at(6)), (3, "s1", at(7)), (4, "s2", at(2)), (5, "s2", at(4)), (6, None, at(4)), (7, "s1", at(5)), (7, "s1", at(5))], "id int, seller string, at string").withColumn("at", F.to_timestamp("at"))
    roles = [H.Role("seller_sk", "sellers", {"seller": "id"}, "sk", {"zip": "seller_zip"}), H.Role("zip_sk", "zips", {"seller_zip": "id"}, "sk")]
    rows, proof = H.resolve_roles(fact, {"sellers": sellers, "zips": zips}, roles, ["id"], "at")
    assert rows.columns == ["id", "seller", "at", "seller_sk", "zip_sk"]
    assert sorted((r.id, r.seller_sk, r.zip_sk) for r in rows.collect() if r.id < 4) == [(1, 1, 10), (2, 2, 20), (3, 2, 20), (3, 2, 21)]
    assert {r.id: (r.n_rows, r.missing, r.ambiguous) for r in proof.collect()} == {3: (2, [], ["zip_sk"]), 4: (1, ["seller_sk", "zip_sk"], []), 5: (1, ["zip_sk"], []), 6: (1, ["seller_sk", "zip_sk"], []), 7: (2, [], [])}


def batch(spark, rows, at):
    return spark.createDataFrame(rows, "k string, v string").withColumn("hash", F.sha2("v", 256)).withColumn("at", F.lit(at).cast("timestamp"))


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    root, keys = str(tmp_path / "h"), [f"k{i}" for i in range(60)]
    first = H.scd2_backfill(batch(spark, [(k, "a") for k in keys], "2018-01-01"), ["k"], "at", "hash")
    S.create_history(first, root, ["k"], 16)
    files = lambda: {str(p) for p in Path(root).rglob("*.parquet")}
    live = lambda: {b: v for b, v in S.marker(spark, root)["versions"].items()}
    before, versions = files(), live()
    assert S.apply_batch(batch(spark, [(k, "a") for k in keys], "2018-02-01"), root, "hash", "at") == [] and files() == before
    changed = S.apply_batch(batch(spark, [(k, "b" if k == "k7" else "a") for k in keys] + [("new", "x")], "2018-03-01"), root, "hash", "at")
    assert 1 <= len(changed) <= 2 and before <= files() and {b for b, v in live().items() if versions.get(b) != v} == {str(b) for b in changed}
    late = S.apply_batch(batch(spark, [("k7", "late")], "2018-02-01"), root, "hash", "at")
    assert len(late) == 1
    got = S.read_history(spark, root)
    want = H.scd2_apply(H.scd2_apply(first, batch(spark, [("k7", "b"), ("new", "x")], "2018-03-01"), ["k"], "hash", "at"), batch(spark, [("k7", "late")], "2018-02-01"), ["k"], "hash", "at")
    assert got.drop("bucket").select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count() == 63
    assert H.scd2_integrity(got.withColumn("sk", F.monotonically_increasing_id()), ["k"], "sk").count() == 0
    one = got.filter(F.col("bucket") == late[0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in one


def test_contradictions_and_races_are_conflicts(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "h")
    with pytest.raises(ValueError, match="no history"):
        S.read_history(spark, root)
    S.create_history(H.scd2_backfill(batch(spark, [("a", "x")], "2018-01-01"), ["k"], "at", "hash"), root, ["k"], 4)
    for rows in ([("a", "y"), ("a", "z")], [("a", "y")]):
        with pytest.raises(Conflict):
            S.apply_batch(batch(spark, rows, "2018-02-01" if len(rows) == 2 else "1900-01-01"), root, "hash", "at")
    other = json.loads(Path(root, "_buckets", "00000000.json").read_text())
    monkeypatch.setattr(S, "marker", lambda *a: other)
    assert len(S.apply_batch(batch(spark, [("a", "y")], "2018-02-01"), root, "hash", "at")) == 1
    before = sorted(map(str, Path(root).rglob("*.parquet")))
    with pytest.raises(Conflict, match="meanwhile"):
        S.apply_batch(batch(spark, [("a", "z")], "2018-03-01"), root, "hash", "at")
    assert sorted(map(str, Path(root).rglob("*.parquet"))) == before


def test_an_empty_history_takes_its_first_batch(spark, tmp_path):
    root = str(tmp_path / "h")
    S.create_history(spark.createDataFrame([], HISTORY), root, ["k"], 4)
    assert S.read_history(spark, root).count() == 0
    S.apply_batch(batch(spark, [("a", "x"), ("b", "x")], "2018-02-01"), root, "hash", "at")
    assert sorted((r.k, str(r.effective), r.is_current) for r in S.read_history(spark, root).collect()) == [("a", H.BEGINNING, True), ("b", H.BEGINNING, True)]
