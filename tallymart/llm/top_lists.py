"""Top lists, merged up a tree."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Lists that one merge takes.
FAN = 16
#: An entry of a list; lists are in ascending order of it: highest score first, then smallest identifier, a null one last.
TOP = "array<struct<fallen:bigint,nameless:boolean,id:bigint>>"


def selected(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest scores of each row (all, if fewer), highest first; of equal scores the first columns."""
    n = scores.shape[1]
    if n > k:
        least = np.partition(scores, n - k, axis=1)[:, n - k, None]
        above, equal = scores > least, scores == least
        equal &= np.cumsum(equal, axis=1) <= k - above.sum(axis=1, keepdims=True)
        columns = np.nonzero(above | equal)[1].reshape(len(scores), k)
    else:
        columns = np.broadcast_to(np.arange(n), scores.shape)
    return np.take_along_axis(columns, np.argsort(-np.take_along_axis(scores, columns, axis=1), axis=1, kind="stable"), axis=1)


def lists(scores: np.ndarray, ids: pa.Array, ends: np.ndarray) -> pa.Array:
    """Lists of TOP from flat scores and identifiers; ends: where each list starts, and the end of the last."""
    entry = pa.StructArray.from_arrays([pa.array(-scores, pa.int64()), ids.is_null(), ids], names=["fallen", "nameless", "id"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entry)


def merged(tops: DataFrame, keys: Sequence[str], nodes: int, k: int) -> DataFrame:
    """keys, top: the k first entries over all nodes. tops: keys, node (0 to nodes - 1), top.

    A merge takes at most FAN lists of a key, so no key is gathered whole, however many nodes there are.
    """
    while nodes > 1:
        nodes = -(-nodes // FAN)
        up = F.floor(F.col("node") / FAN).alias("node")
        tops = tops.groupBy(*keys, up).agg(F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
    return tops.select(*keys, "top")
