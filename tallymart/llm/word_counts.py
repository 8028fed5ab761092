"""Counts of words over all documents, combined inside each task before they are shuffled."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Distinct words that a task gathers before it hands them on.
GATHERED = 300_000


def fold(id_col: Column, modulus: int) -> Column:
    """crc32 of the identifier as text, modulo modulus; -1 for a null identifier."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(modulus)), F.lit(-1)).cast("int")


def word_counts(docs: DataFrame, group: str | None = None, end: bytes | None = None) -> DataFrame:
    """`grp`, `word` (binary), `n`: how often a word is in the texts of a group.

    Words are the ASCII-lower-cased `[^\\x20\\x09-\\x0D]+` of column `text`; group names a string
    column or is None; `end` is counted once for each document. A frequent word is one row a flush,
    so no key is hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str | None, Counter] = {}

        def flush() -> pa.RecordBatch:
            groups = [g for g, c in seen.items() for _ in range(len(c))]
            words = [w for c in seen.values() for w in c]
            ns = [n for c in seen.values() for n in c.values()]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), pa.array(words, pa.binary()), pa.array(ns, pa.int64())], names=["grp", "word", "n"])

        for batch in batches:
            for g, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
                counter = seen.setdefault(g, Counter())
                counter.update((text.as_py() or b"").lower().split())
                if end is not None:
                    counter[end] += 1
                if sum(map(len, seen.values())) >= GATHERED:
                    yield flush()
        yield flush()

    light = docs.select((F.col(group).cast("string") if group else F.lit(None).cast("string")).alias("grp"), F.col("text"))
    return light.mapInArrow(run, "grp string, word binary, n long").groupBy("grp", "word").agg(F.sum("n").alias("n"))
