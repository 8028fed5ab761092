"""Exact top-k search by inner product: tiles of queries and shards, partial selection in each, lists merged up a tree.

1. Queries are packed into groups and all vectors into shards, as blocks of whole numbers. How many groups and shards there are
   follows from the number of rows and the longest vector, so that either fits a task at any size of the table.
2. A tile is a group and a shard that meet in a task: every group is sent to every shard by its key (no broadcast, nothing
   through the driver). The tile's scores are matrix products, and only each query's best of the tile leave it.
3. The lists of a query are merged up a tree over the shards, sixteen at a time.

The work is that of the products, queries times rows; a tile of 8,192 by 8,192 sends 16 k numbers a dimension for 67 M products.

Defined cases: a vector that is null or has a null or non-finite entry is neither query nor candidate. A shorter vector counts as
if zeros followed. Entries beyond the range of a long are taken as its ends, and so are scores. A null identifier is no query; as a
candidate it comes last among equal scores. Repeated rows are queries and candidates each; a query's own row is none, copies of it
are. An empty table gives an empty result. Columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import written
from tallymart.llm.top_lists import TOP, lists, merged, selected
from tallymart.llm.vectors import as_doubles, entries, largest, longest

#: Rows of a shard and of a group of queries, and the most bytes that their entries take.
ROWS, BYTES = 8_192, 16 << 20
#: Queries whose scores are held at once.
AT_ONCE = 512
SCALE = 1024
#: Range of the scores.
MOST = 2**63 - 1


def blocks(rows: DataFrame, width: int, most: int) -> DataFrame:
    """rows (id, vec) as block (a number of its own), part (its task), ids, x (int64 entries); at most `most` rows a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            fine, x = entries(batch.column(1), SCALE, width)
            ids = batch.column(0).filter(pa.array(fine))
            for at in range(0, len(x), most):
                columns = [[(part << 32) + k], [part], [ids[at : at + most].to_pylist()], [x[at : at + most].tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()), strict=True)], names=["block", "part", "ids", "x"])
                k += 1

    return rows.mapInArrow(run, "block long, part int, ids array<long>, x binary")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b as int64: exact, and taken as the ends of the range beyond it."""
    bound = largest(a) * largest(b) * a.shape[1]
    if bound < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if bound <= MOST:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -MOST, MOST).astype(np.int64)


def squares(a: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a with themselves, as products gives them."""
    if largest(a) ** 2 * a.shape[1] <= MOST:
        return (a * a).sum(axis=1)
    return np.minimum((a.astype(object) ** 2).sum(axis=1), MOST).astype(np.int64)


def stacked(table: pa.Table, width: int) -> tuple[pa.Array, np.ndarray]:
    """(identifiers, entries) of all blocks of a table."""
    ids = pa.concat_arrays([c.flatten() for c in table.column("ids").chunks])
    return ids, np.frombuffer(b"".join(table.column("x").to_pylist()), np.int64).reshape(len(ids), width)


def tile(width: int, k: int):
    """The function of a tile: its queries' best k + 1 rows, as one of them may be the query's own."""

    def run(key: tuple, queries: pa.Table, shard: pa.Table) -> pa.Table:
        rows: list[pa.RecordBatch] = []
        if queries.num_rows and shard.num_rows:
            ids, x = stacked(shard, width)
            order = pa.compute.sort_indices(ids)  # nulls last
            ids, x = ids.take(order), x[order.to_numpy()]
            queries = queries.sort_by("block")
            for block, names, raw in zip(*(queries.column(c).to_pylist() for c in ("block", "ids", "x")), strict=True):
                q = np.frombuffer(raw, np.int64).reshape(-1, width)
                for at in range(0, len(q), AT_ONCE):
                    part = q[at : at + AT_ONCE]
                    scores = products(part, x)
                    columns = selected(scores, k + 1)
                    best = np.take_along_axis(scores, columns, axis=1)
                    own = squares(part)
                    size = columns.shape[1]
                    rows.append(pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), block)), pa.array(np.arange(at, at + len(part))), pa.array(names[at : at + AT_ONCE], pa.int64()), pa.array(own), pa.array(np.full(len(part), key[0].as_py())), lists(best.ravel(), ids.take(pa.array(columns.ravel())), np.arange(0, size * len(part) + 1, size))],
                        names=["block", "at", "query_id", "own", "node", "top"],
                    ))
        return pa.Table.from_batches(rows, SHAPE)

    return run


ENTRY = pa.struct([("fallen", pa.int64()), ("nameless", pa.bool_()), ("id", pa.int64())])
SHAPE = pa.schema([("block", pa.int64()), ("at", pa.int64()), ("query_id", pa.int64()), ("own", pa.int64()), ("node", pa.int64()), ("top", pa.list_(ENTRY))])


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row whose identifier is divisible by `every`."""
    rows = as_doubles(vectors, id_col, vec_col)
    asks = F.col("id") % every == 0
    n, n_queries, width = rows.agg(F.count("*"), F.count_if(asks), longest(F.col("vec"))).first()
    most = max(1, min(ROWS, BYTES // (8 * max(width, 1))))
    shards, groups = -(-n // most) or 1, -(-n_queries // most) or 1
    asked = written(blocks(rows.filter(asks).repartition(groups), width, most), "query-blocks")
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumnRenamed("part", "group")
    given = blocks(rows, width, most).withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int")).drop("part")
    given = given.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    tops = asked.groupBy("shard", "group").cogroup(given.groupBy("shard", "group")).applyInArrow(tile(width, k), f"block long, at long, query_id long, own long, node long, top {TOP}")
    best = merged(tops, ["block", "at", "query_id", "own"], shards, k + 1)
    own = F.array_position("top", F.struct((-F.col("own")).alias("fallen"), F.lit(False).alias("nameless"), F.col("query_id").alias("id")))
    others = F.when(own == 0, F.col("top")).otherwise(F.concat(F.slice("top", F.lit(1), F.greatest(own.cast("int") - 1, F.lit(0))), F.slice("top", own.cast("int") + 1, F.lit(k + 1))))
    ranked = best.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "e"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("e.id").alias("vec_id"), (-F.col("e.fallen")).alias("score"))
