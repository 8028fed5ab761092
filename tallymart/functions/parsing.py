"""From text to typed columns, and from typed columns to a contract."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tallymart.contracts import Contract, spark_type

RAW = "_raw__"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parsed(text: Column, kind: str) -> Column:
    """The text as a value of the type, null where it is blank or none."""
    clean = F.nullif(F.trim(text), F.lit(""))
    if kind == "timestamp":
        return F.try_to_timestamp(clean, F.lit(TIMESTAMP_FORMAT))
    return clean if kind == "string" else clean.try_cast(spark_type(kind))


def normalize(df: DataFrame, contract: Contract) -> DataFrame:
    """Each field trimmed and typed under its canonical name, beside its text as _raw__<name>."""
    raw = [F.col(f.source_name).alias(RAW + f.name) for f in contract.fields]
    return df.select(*[parsed(F.col(f.source_name), f.type).alias(f.name) for f in contract.fields], *raw)


def fill_null(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna(values)


def lower_col(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.lower(name))


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Names in lower case with blanks and hyphens as underscores."""
    return df.toDF(*[c.lower().replace(" ", "_").replace("-", "_") for c in df.columns])


def add_run_metadata(df: DataFrame, batch_id: str, source_file_id: str, ingested: str, processed: str, version: int) -> DataFrame:
    stamps = {"ingestion_timestamp": ingested, "processing_timestamp": processed}
    more = {"batch_id": F.lit(batch_id), "source_file_id": F.lit(source_file_id), **{k: F.lit(v).cast("timestamp") for k, v in stamps.items()}, "contract_version": F.lit(version)}
    return df.withColumns(more)


def project_contract(df: DataFrame, contract: Contract, extra: Iterable[str] = ()) -> DataFrame:
    """The contract's columns, in its order and types, and any extra ones."""
    return df.select(*[F.col(f.name).cast(spark_type(f.type)).alias(f.name) for f in contract.fields], *extra)


def null_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """column_name, missing for columns that have nulls; one pass."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.unpivot([], names, "column_name", "missing").filter("missing > 0")
