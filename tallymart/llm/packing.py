"""Best-fit packing of tokenised documents into sequences of bounded length, in bulk-synchronous rounds.

Pieces are taken by size class from large to small (each class reaches to twice its lower end). A round
for a class:

1. Pieces and gaps (what is free in open sequences) are range-sorted together, largest value first,
   a gap before an equal piece. Ties are split by identifier, so one frequent length fills many partitions. There are as many
   partitions as the rows of the round ask for.
2. Each partition is swept: a gap becomes free as the sweep comes to it, a piece takes its successor, the smallest free gap
   it fits in, and what is left of that gap is free again.
3. What a partition has left over, pieces first and then gaps, is matched across partitions: a row for
   each partition says how many pieces and places are over (a gap has as many places as pieces of the class surely fit), the
   driver pairs these numbers from the nearest partition outwards, and the pieces take the places by rank. No two pieces get
   one place.
4. The gaps shrink by what they took. The round is repeated until nothing can be paired across partitions: then no piece that
   is over fits into any gap. These open new sequences, in which each partition packs its own pieces best-fit; their gaps join
   the others.

The number of rounds depends on the sequence length, not on the number of documents. Tokens are those of the
public byte-level vocabulary followed by an end token; only documents longer than a sequence are cut,
the first piece taking the remainder.

Defined cases: a null text is empty and is the end token alone. Bytes that are not UTF-8 count as U+FFFD. Repeated rows are packed as often as they
occur. A null identifier passes through. An empty table gives an empty result. Columns other than the
two named are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallymart.llm.common import written

SPECIAL = b"<|endoftext|>"
#: White space that goes to the tokenizer itself: the fast one steps back through a run by its pattern and its stack ends at a million.
LONG, LONG_RUN = 100_000, re.compile(r"(?<!\s)\s{100000}")
#: Rows that a task sweeps, about: the least, and the most where there are so many that TASKS tasks would have more than that.
ROWS_A_TASK, MOST_ROWS_A_TASK, TASKS = 20_000, 500_000, 2_000
#: Partition ranges paired by the driver that may be broadcast (six numbers each, at most two for a partition of a round).
BROADCAST_PAIRS = 200_000


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit numbers.

    From the rank file of the vocabulary, which takes a sixth of the tokenizer object's time; a text with the special
    token's string or a very long run of white space goes through the tokenizer itself. Bytes that are not UTF-8 count as U+FFFD.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(tokenizer_path)

    def encode(self, raw: bytes) -> bytes:
        text = raw.decode(errors="replace")
        if SPECIAL in raw or (len(text) >= LONG and LONG_RUN.search(text)):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(array("I", self.fast.encode_ordinary(text)), "<u4").tobytes()


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder_for(tokenizer_path: str, ranks_path: str) -> Encoder:
    key = (tokenizer_path, ranks_path)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n tokens."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer_path: str, ranks_path: str, capacity: int, end: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32; a narrow step."""
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_for(tokenizer_path, ranks_path).encode
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
                ids = encode(text.as_py() or b"") + last
                rows += [(doc_id, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(ids) // 4, capacity))]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    light = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return light.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def classes(capacity: int) -> list[tuple[int, int]]:
    """(low, high] from large to small, each half the one before; the last is length 1 alone."""
    out, high = [], capacity - 1
    while high > 1:
        low = capacity // 2 if high == capacity - 1 else high // 2
        out.append((low, high))
        high = low
    return [*out, (0, high)]


class Open:
    """Gaps by size: a bit for each size that is there, so the successor of a length is one shift away."""

    def __init__(self) -> None:
        self.bits, self.by_size = 0, {}

    def put(self, size: int, what: int) -> None:
        if size > 0:
            self.bits |= 1 << size
            self.by_size.setdefault(size, []).append(what)

    def take(self, length: int) -> tuple[int, int] | None:
        above = self.bits >> length
        if not above:
            return None
        size = length + (above & -above).bit_length() - 1
        what = self.by_size[size].pop()
        if not self.by_size[size]:
            self.bits &= ~(1 << size)
        return size, what

    def rest(self) -> Iterator[tuple[int, int]]:
        """Size and gap of all that is left, the smallest first."""
        return ((size, what) for size in sorted(self.by_size) for what in self.by_size[size])


def in_partitions(rows: DataFrame, n: int, order: list) -> DataFrame:
    """rows range-sorted by order, in as many partitions as n rows ask for."""
    rows_a_task = max(ROWS_A_TASK, min(MOST_ROWS_A_TASK, n // TASKS))
    return rows.repartitionByRange(-(-n // rows_a_task) or 1, *order).sortWithinPartitions(*order)


def record(columns: dict[str, tuple[pa.DataType, list]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for kind, values in columns.values()], names=list(columns))


def open_sequences(items: DataFrame, capacity: int, n: int) -> DataFrame:
    """item, length of one class (about n rows) to item, length, seq and gap: new sequences, packed best-fit within each partition.

    gap is what a sequence has left, in the row of the last piece that came to it, else null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps, items, lengths, seqs, last = Open(), [], [], [], {}
        for batch in batches:
            for item, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                size, seq = gaps.take(length) or (capacity, item)
                gaps.put(size - length, seq)
                last[seq] = len(items), size - length
                items.append(item), lengths.append(length), seqs.append(seq)
        left: list[int | None] = [None] * len(items)
        for at, gap in last.values():
            left[at] = gap
        yield record({"item": (pa.int64(), items), "length": (pa.int64(), lengths), "seq": (pa.int64(), seqs), "gap": (pa.int64(), left)})

    return in_partitions(items.select("item", "length"), n, [F.desc("length"), F.col("item")]).mapInArrow(run, "item long, length long, seq long, gap long")


def swept(items: DataFrame, gaps: DataFrame, high: int, n: int) -> DataFrame:
    """A round over pieces of a class (at most `high`) and gaps, about n rows together, as a written table.

    item, length, seq: a piece that found a gap. item, length, part, rank: a piece that is over. seq, gap, part, rank, places: a
    gap (what is left of it) that is over, the smallest of a partition first; rank counts the places before.
    """
    both = items.select(F.col("length").alias("value"), F.lit(1).alias("kind"), F.col("item").alias("id")).unionByName(gaps.select(F.col("gap").alias("value"), F.lit(0).alias("kind"), F.col("seq").alias("id")))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, free, over = TaskContext.get().partitionId(), Open(), 0
        rows: list[tuple] = []
        for batch in batches:
            for value, kind, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not kind:
                    free.put(value, name)
                elif (found := free.take(value)) is not None:
                    free.put(found[0] - value, found[1])
                    rows.append((name, value, found[1], None, None, None, 0))
                else:
                    rows.append((name, value, None, None, part, over, 0))
                    over += 1
        rank = 0
        for size, seq in free.rest():
            places = max(1, size // high)
            rows.append((None, None, seq, size, part, rank, places))
            rank += places
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        cols = list(zip(*rows, strict=True)) or [[]] * 7
        yield record({k: (t, c) for k, t, c in zip(("item", "length", "seq", "gap", "part", "rank", "places"), types, cols, strict=True)})

    schema = "item long, length long, seq long, gap long, part int, rank long, places long"
    return written(in_partitions(both, n, [F.desc("value"), F.col("kind"), F.col("id")]).mapInArrow(sweep, schema), "pack-sweep")


def paired(done: DataFrame) -> tuple[list[tuple], int, int]:
    """(Ranks of pieces and places, paired from the nearest partition outwards; number of pieces and of gaps that are over)."""
    counts = done.filter("part IS NOT NULL").groupBy("part").agg(F.count("item").alias("pieces"), F.coalesce(F.sum("places"), F.lit(0)).alias("places"), F.count("gap").alias("gaps")).orderBy("part").collect()
    waiting, pairs = [], []
    for part, n, places, _ in counts:
        first = 0
        while n > first and waiting:
            take = min(n - first, waiting[-1][2])
            pairs.append((len(pairs), part, first, first + take, waiting[-1][0], waiting[-1][1]))
            first += take
            waiting[-1][1] += take
            waiting[-1][2] -= take
            if not waiting[-1][2]:
                waiting.pop()
        if places:
            waiting.append([part, 0, places])
    return pairs, sum(c["pieces"] for c in counts), sum(c["gaps"] for c in counts)


def across(pieces: DataFrame, gaps: DataFrame, pairs: list[tuple]) -> DataFrame:
    """item, length, seq: the pieces that are over and have a place in a gap of another partition, by rank."""
    p = pieces.sparkSession.createDataFrame(pairs, "pair long, p_part int, lo long, hi long, gap_part int, gap_lo long")
    p = F.broadcast(p) if len(pairs) <= BROADCAST_PAIRS else p
    left = pieces.join(p, (F.col("part") == F.col("p_part")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    left = left.select("pair", (F.col("rank") - F.col("lo")).alias("k"), "item", "length")
    hi = F.col("gap_lo") + F.col("hi") - F.col("lo")
    right = gaps.join(p, (F.col("part") == F.col("gap_part")) & (F.col("rank") < hi) & (F.col("rank") + F.col("places") > F.col("gap_lo")))
    inside = F.sequence(F.greatest("rank", "gap_lo"), F.least(F.col("rank") + F.col("places"), hi) - 1)
    right = right.select("pair", "seq", "gap_lo", F.explode(inside).alias("at")).select("pair", (F.col("at") - F.col("gap_lo")).alias("k"), "seq")
    return left.join(right, ["pair", "k"]).select("item", "length", "seq")


def best_fit(items: DataFrame, capacity: int) -> DataFrame:
    """item (unique), length <= capacity to item, length, seq, offset."""
    placed = [items.filter(F.col("length") == capacity).select("item", "length", F.col("item").alias("seq"))]
    steps = classes(capacity)
    of_class = F.coalesce(*[F.when(F.col("length") > low, F.lit(k)) for k, (low, _) in enumerate(steps)])
    sizes = {r["k"]: r["n"] for r in items.filter(F.col("length") < capacity).groupBy(of_class.alias("k")).agg(F.count("*").alias("n")).collect()}
    gaps = None
    for k, (low, high) in enumerate(steps):
        n = sizes.get(k, 0)
        if not n:
            continue
        left = items.filter((F.col("length") > low) & (F.col("length") <= high)).select("item", "length")
        n_gaps = 0 if gaps is None else gaps.filter(F.col("gap") > low).count()
        while n and n_gaps:
            # Gaps of at most `low` take no piece of this class; they wait.
            small, done = gaps.filter(F.col("gap") <= low), swept(left, gaps.filter(F.col("gap") > low), high, n + n_gaps)
            placed.append(done.filter("item IS NOT NULL AND seq IS NOT NULL").select("item", "length", "seq"))
            pairs, n, n_gaps = paired(done)
            left, over = done.filter("seq IS NULL").select("item", "length"), done.filter("item IS NULL AND gap > 0")
            if not pairs:
                gaps = small.unionByName(over.select("seq", "gap"))
                break
            found = written(across(done.filter("seq IS NULL"), over, pairs), "pack-found")
            placed.append(found)
            took = found.groupBy("seq").agg(F.sum("length").alias("took"))
            gaps = written(small.unionByName(over.join(took, "seq", "left").select("seq", (F.col("gap") - F.coalesce("took", F.lit(0))).alias("gap")).filter("gap > 0")), "pack-gaps")
            left = left.join(found.select("item"), "item", "left_anti")
            n -= sum(hi - lo for _, _, lo, hi, _, _ in pairs)
        if not n:
            continue
        opened = written(open_sequences(left, capacity, n), "pack-opened")
        placed.append(opened.select("item", "length", "seq"))
        fresh = opened.filter("gap > 0").select("seq", "gap")
        gaps = fresh if gaps is None else gaps.unionByName(fresh)
    all_placed = placed[0]
    for more in placed[1:]:
        all_placed = all_placed.unionByName(more)
    # At most `capacity` pieces a sequence, so the window's groups are bounded.
    before = Window.partitionBy("seq").orderBy(F.desc("length"), "item").rowsBetween(Window.unboundedPreceding, -1)
    return all_placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def packed(docs: DataFrame, tokenizer_path: str, ranks_path: str, capacity: int = 1024, end: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece."""
    table = written(pieces(docs, tokenizer_path, ranks_path, capacity, end, id_col, text_col).withColumn("item", F.monotonically_increasing_id()), "pack-pieces")
    placed = best_fit(table.select("item", "length"), capacity).select("item", F.col("seq").alias("sequence_id"), "offset")
    return table.join(placed, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
