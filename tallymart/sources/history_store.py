"""A dimension's history as a table in buckets of its keys, of which a batch rewrites only those that it changes.

A bucket's rows lie in `<root>/version=<version>/bucket=<n>`, written once. A marker, `<root>/_buckets/<number>.json`, names the version
of every bucket; it is created if absent, so of two batches applied side by side one has to start again. Readers find their folders
through the marker with the largest number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallymart.operators.history import intervals, scd2_conflicts, scd2_opened
from tallymart.sources.publication import Conflict, children, create_if_absent
from tallymart.tables import remove, written


def bucket_of(keys: Sequence[str], n: int):
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def marker(spark: SparkSession, root: str) -> dict:
    """The marker that holds: number, fields, keys, n_buckets, versions (bucket to version)."""
    found = [n for n, _ in children(spark, f"{root}/_buckets") if n.endswith(".json") and not n.startswith(".")]
    if not found:
        raise ValueError(f"no history under {root}")
    return json.loads(spark.read.text(f"{root}/_buckets/{max(found)}", wholetext=True).first()[0])


def write_buckets(rows: DataFrame, root: str, version: str, n_buckets: int, keys: Sequence[str]) -> None:
    """A file for each bucket that has rows."""
    rows.withColumn("bucket", bucket_of(keys, n_buckets)).repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/version={version}")


def commit(spark: SparkSession, root: str, state: dict) -> None:
    if not create_if_absent(spark, f"{root}/_buckets/{state['number']:08d}.json", json.dumps(state)):
        raise Conflict(f"another batch was applied to {root} meanwhile")


def create_history(history: DataFrame, root: str, keys: Sequence[str], n_buckets: int) -> None:
    """Write a history (keys, attributes, hash, effective, expiration, is_current) for the first time."""
    spark, version = history.sparkSession, uuid.uuid4().hex
    write_buckets(history, root, version, n_buckets, keys)
    have = [int(n.removeprefix("bucket=")) for n, _ in children(spark, f"{root}/version={version}") if n.startswith("bucket=")]
    commit(spark, root, {"number": 0, "fields": history.schema.json(), "keys": list(keys), "n_buckets": n_buckets, "versions": {str(b): version for b in have}})


def read_history(spark: SparkSession, root: str, state: dict | None = None) -> DataFrame:
    """The history with its bucket; a filter on bucket prunes folders."""
    state = state or marker(spark, root)
    schema = T.StructType.fromJson(json.loads(state["fields"])).add("version", "string").add("bucket", "integer")
    paths = [f"{root}/version={v}/bucket={b}" for b, v in state["versions"].items()]
    if not paths:
        return spark.createDataFrame([], schema).drop("version")
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).drop("version")


def apply_batch(snapshot: DataFrame, root: str, hash_col: str, effective: str) -> list[int]:
    """Apply a batch's snapshot; the buckets that were rewritten. Raises Conflict where another batch came first or the snapshot contradicts
    the history (a key twice, a version of the same time with other content).

    The versions that the batch opens are found first and written; then only buckets with one are read whole and written anew.
    """
    spark = snapshot.sparkSession
    state = marker(spark, root)
    keys, n = state["keys"], state["n_buckets"]
    history = read_history(spark, root, state)
    touched = [r[0] for r in snapshot.select(bucket_of(keys, n).alias("bucket")).distinct().collect()]  # at most n_buckets
    near = history.filter(F.col("bucket").isin(touched)).drop("bucket")
    if scd2_conflicts(near, snapshot, keys, hash_col, effective).limit(1).count():
        raise Conflict("the snapshot contradicts the history")
    opened = written(scd2_opened(near, snapshot, keys, hash_col, effective).withColumn("bucket", bucket_of(keys, n)), "opened")
    changed = sorted(r[0] for r in opened.select("bucket").distinct().collect())
    if not changed:
        return []
    version = uuid.uuid4().hex
    columns = [c for c in opened.columns if c != "bucket"]
    new = intervals(history.filter(F.col("bucket").isin(changed)).select(*columns).unionByName(opened.select(*columns)), keys)
    names = [f["name"] for f in json.loads(state["fields"])["fields"]]
    try:
        write_buckets(new.select(*names), root, version, n, keys)
        commit(spark, root, state | {"number": state["number"] + 1, "versions": state["versions"] | {str(b): version for b in changed}})
    except Exception:
        remove(spark, f"{root}/version={version}")
        raise
    return changed
