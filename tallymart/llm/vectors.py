"""Vectors as whole numbers: what the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: Largest magnitude of an entry: the largest double below 2 ** 63. Entries beyond are taken as this.
LARGEST = float(2**63 - 1024)


def as_doubles(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec: the two columns, entries as doubles; other columns of any name are left out."""
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))


def longest(vec: Column) -> Column:
    """The largest number of entries of a vector."""
    return F.coalesce(F.max(F.size(vec)), F.lit(0)).cast("int")


def entries(vectors: pa.Array, scale: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(Which vectors take part, floor(scale * entry) of those as int64 rows of `width`).

    A null vector and one with a null or non-finite entry take no part. A shorter vector counts as if zeros followed.
    """
    vectors = vectors.cast(pa.large_list(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    fine = vectors.is_valid().to_numpy(zero_copy_only=False).copy()
    fine[row[~np.isfinite(values)]] = False
    whole = np.zeros((len(lengths), width), np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        whole[row, column] = np.clip(np.floor(scale * values), -LARGEST, LARGEST)
    return fine, whole[fine].astype(np.int64)


def largest(x: np.ndarray) -> int:
    """The largest magnitude in x as a Python integer."""
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
