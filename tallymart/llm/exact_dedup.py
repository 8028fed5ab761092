"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition becomes a run, or several where there are few partitions: one entry for each distinct text in it, with
the digest, a verification (length in bytes and a second, independent 64-bit hash), the best row and the number
of rows, sorted by digest. A run is a row for each bucket of the digest space with its sorted entries, so it stays sorted on its way.
In each round the runs r, r + s, r + 2s, ... of a block of `fan_in` meet and are merged by a multiway merge of sorted
sequences; with a fan-in of 2, s doubles each round (binomial rounds). Entries agree only if digest and verification agree: that
is what equal texts are here. Buckets are of bounded size, so no task ever holds more than `fan_in` runs of one bucket, and a text with
any number of copies is one entry a run from the start: there is no hot group.

Defined cases: a null text counts as empty (all empty texts are one group). Of equal texts the row
with the largest identifier stays; a null identifier is smaller than any other. Of repeated rows with
the same identifier and text one stays. An empty table gives an empty result. Columns of the input
other than the two named are ignored, so their names may clash with anything here.
"""

from __future__ import annotations

import heapq
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import by_run, unused, written

ENTRY = {"digest": "string", "n_bytes": "long", "second": "long", "has_id": "boolean", "best_id": "long", "best_row": "long", "copies": "long"}
KEY = ["digest", "n_bytes", "second"]
#: Runs that there are at least, whatever the number of partitions.
LEAST_RUNS = 8


def merge_runs(runs: list[list[tuple]]) -> list[tuple]:
    """Merge sorted runs of (digest, n_bytes, second, has_id, best_id, best_row, copies)."""
    out = []
    for key, same in groupby(heapq.merge(*runs), key=lambda e: e[:3]):
        same = list(same)
        out.append((*key, *max(e[3:6] for e in same), sum(e[6] for e in same)))
    return out


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: run, row, identifier, digest and verification; written once."""
    text, parts = F.coalesce(F.col(text_col), F.lit("")), F.lit(-(-LEAST_RUNS // max(1, docs.rdd.getNumPartitions())))
    light = docs.select(
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.sha2(text, 256).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.xxhash64(F.lit("second"), text).alias("second"),
    )
    return written(light.withColumn("run", (F.col("part") * parts + F.pmod("row", parts)).cast("int")).drop("part"), "digest-runs")


def sorted_runs(runs: DataFrame, buckets: int) -> DataFrame:
    """run, bucket, entries: the distinct texts of each run and bucket with their best row and number, sorted."""
    best = F.max(F.struct(F.col("id").isNotNull().alias("has_id"), F.coalesce("id", F.lit(0)).alias("best_id"), F.col("row").alias("best_row")))
    entries = runs.groupBy("run", *KEY).agg(best.alias("b"), F.count("*").alias("copies")).select("run", F.struct(*KEY, "b.has_id", "b.best_id", "b.best_row", "copies").alias("entry"))
    return entries.groupBy("run", F.pmod(F.xxhash64("entry.digest"), F.lit(buckets)).alias("bucket")).agg(F.sort_array(F.collect_list("entry")).alias("entries"))


def merged_runs(runs: DataFrame, n_runs: int, fan_in: int) -> DataFrame:
    """run, bucket, entries to the same with one run: rounds in which blocks of fan_in runs are merged."""
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    entries = pa.list_(pa.struct([(n, kinds[t]) for n, t in ENTRY.items()]))

    def merge(table: pa.Table) -> pa.Table:
        parts = [list(zip(*(cell.values.field(n).to_pylist() for n in ENTRY), strict=True)) for cell in table.column("entries").cast(entries).combine_chunks()]
        out = [dict(zip(ENTRY, e, strict=True)) for e in merge_runs(parts)]
        return pa.table({"run": pa.array([table.column("run")[0].as_py() // fan_in], pa.int32()), "bucket": table.column("bucket").slice(0, 1), "entries": pa.array([out], entries)})

    schema = f"run int, bucket long, entries array<struct<{','.join(f'{n}:{t}' for n, t in ENTRY.items())}>>"
    while n_runs > 1:
        runs = runs.groupBy(F.floor(F.col("run") / fan_in), "bucket").applyInArrow(merge, schema)
        n_runs = -(-n_runs // fan_in)
    return runs


def winners(runs: DataFrame, fan_in: int = 2, bucket_rows: int = 50_000) -> DataFrame:
    """Entries of the merged run. bucket_rows: entries of a bucket in one run, about."""
    seen = runs.agg(F.max("run").alias("last"), F.count("*").alias("n")).first()
    n_runs, buckets = (seen["last"] or 0) + 1, max(16, -(-seen["n"] // bucket_rows))
    return merged_runs(sorted_runs(runs, buckets), n_runs, fan_in).select(F.explode("entries").alias("e")).select("e.*")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 2) -> DataFrame:
    """A row for each document: id_col, keep_id, group_size, kept, text_sha256.

    The answer goes back the way it came: the merged entries to the entries of each run (at most one
    a run and text), those to the run's own documents. A group of copies with a third of all rows is
    thereby spread over the runs.
    """
    runs = digest_runs(docs, id_col, text_col)
    merged = written(winners(runs, fan_in), "digest-winners")
    answers = merged.select(*KEY, F.when(F.col("has_id"), F.col("best_id")).alias("keep_id"), F.col("best_row").alias("keep_row"), F.col("copies").alias("group_size"))
    return by_run(runs, KEY, answers).select(
        F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long"), (F.col("row") == F.col("keep_row")).alias("kept"), F.col("digest").alias("text_sha256")
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, all columns. Identifiers must be unique here."""
    name = unused("_stays", docs)
    stays = exact_dedup(docs, id_col, text_col).filter("kept").select(F.col(id_col).alias(name))
    return docs.join(stays, F.col(id_col).eqNullSafe(F.col(name)), "left_semi")
