"""Hashes of rows and fingerprints of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallymart.contracts import Contract
from tallymart.sources.files import file_digests

#: Columns that say when a row is valid or was made, not what it is.
EXCLUDED = ("RecordHash", "RowEffectiveDate", "RowExpirationDate", "CurrentFlag", "LastUpdated")


def canonical(name: str, kind: T.DataType) -> Column:
    """A value as it stands in the hashed JSON: decimals and times as text of fixed form."""
    if isinstance(kind, T.DecimalType):
        return F.col(name).cast("string")
    if isinstance(kind, T.TimestampType):
        return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    if isinstance(kind, T.DateType):
        return F.date_format(name, "yyyy-MM-dd")
    return F.col(name)


def record_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """Compact JSON in the given order, nulls written out."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.to_json(F.struct(*[canonical(c, kinds[c]).alias(c) for c in columns]), {"ignoreNullFields": "false"})


def record_hash(df: DataFrame, contract: Contract | None = None) -> Column:
    names = contract.names if contract else df.columns
    return F.sha2(record_json(df, [c for c in names if c not in EXCLUDED]), 256)


def with_record_hash(df: DataFrame, contract: Contract | None = None) -> DataFrame:
    return df.withColumn("RecordHash", record_hash(df, contract))


def verify_record_hash(df: DataFrame, contract: Contract | None = None) -> DataFrame:
    """Rows whose stored hash is not that of their content; no join is needed."""
    return df.filter(~F.col("RecordHash").eqNullSafe(record_hash(df, contract)))


def tracked_hash(df: DataFrame, attributes: Sequence[str]) -> Column:
    """SHA-256 of the tracked attributes in declared order."""
    return F.sha2(record_json(df, attributes), 256)


def digest_sums(digest: Column) -> list[Column]:
    """Sums of the first and the second 15 hex digits of SHA-256 digests, as text: the same for any order of the rows."""
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)")
    return [F.coalesce(F.sum(part(at)), F.lit(0)).cast("decimal(38,0)").cast("string").alias(name) for at, name in ((1, "sum_first"), (16, "sum_second"))]


def table_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row that any order and layout of the same rows gives: their number and two sums of row digests."""
    return df.agg(F.count("*").alias("n_rows"), *digest_sums(F.sha2(record_json(df, list(columns or df.columns)), 256)))


def fingerprints(frames: Mapping[str, DataFrame]) -> DataFrame:
    """dataset, fingerprint, n_rows of each table."""
    parts = [table_fingerprint(df).select(F.lit(n).alias("dataset"), F.concat_ws(":", "sum_first", "sum_second").alias("fingerprint"), "n_rows") for n, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def file_fingerprint(spark: SparkSession, path: str, suffix: str = "*") -> DataFrame:
    """One row for the files of a folder: number, bytes and two sums of their contents' digests; names have no part in it."""
    return file_digests(spark, path, suffix).agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"), *digest_sums(F.col("digest")))


def publication_fingerprint(summary: DataFrame, batch_id: str, versions: Sequence[str]) -> DataFrame:
    """summary: dataset, fingerprint, n_rows, a row for each published table. Attempt fields have no part in it."""
    lines = F.sort_array(F.collect_list(F.concat_ws("|", "dataset", "fingerprint", F.col("n_rows").cast("string"))))
    return summary.agg(F.sha2(F.concat_ws("\n", F.lit(batch_id), *[F.lit(v) for v in versions], lines), 256).alias("fingerprint"))
