"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

1. Each text becomes its set of word shingles (64-bit hashes) and 252 minimum hashes, which make up 36 bands
   of 7; their last 8 bits are the signature. Equal sets (a digest of 128 bits) are one node from here on, so copies cost nothing.
2. Nodes that share a band are candidates. Bands with the same nodes are one bucket; a large bucket is dealt into blocks of
   bounded size, otherwise for each band.
3. In each block pairs are compared by batches of signature positions. After each batch the posterior
   of the similarity (uniform prior, binomial matches) gives the chance that the pair reaches the threshold;
   a pair whose chance is under `miss` is dropped. Of what is left a forest is handed on, never all pairs; so it is then for the
   pairs between the blocks of large buckets whose nodes are not connected by that. The components of the forest are groups: what
   is left over lies within them.
4. A group's texts meet once, and the pairs that signatures leave over are verified on the full sets. A pair
   that is connected already needs no comparison, and only links that connect something are returned, so the
   output is linear. A large group is dealt into blocks: each is verified within; then classes of different blocks are connected
   by a forest of their likest pairs, and only what signatures still leave over between classes is compared block by block.
5. Components of all verified links are the classes.

Words are `[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased. A text with fewer words than a shingle has its
whole sequence as its only shingle; one without words has an empty set and is linked with nothing.

Defined cases: null text counts as empty. Repeated rows are copies of each other; if they carry the same
identifier both are kept. A null identifier is never a class's identifier unless all are null.
An empty table gives an empty result. Columns other than the two named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import by_run, unused, written
from tallymart.llm.components import components

BANDS, ROWS, BATCH = 36, 7, 36
HASHES = BANDS * ROWS
#: A block of a bucket: documents and shingles, about.
BLOCK_DOCS, BLOCK_SHINGLES = 2_000, 1_000_000
#: Rows of signatures that a task compares, about.
ROWS_A_TASK = 20_000
#: Buckets, candidates or classes (some numbers each) that may be broadcast; beyond it the join shuffles.
BROADCAST_CANDIDATES = 400_000

_rng = np.random.default_rng(20240)
MULTIPLY = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
MIX = _rng.integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - width + 1
    out = h[:n].copy()
    for k in range(1, width):
        out = (out ^ (out >> np.uint64(29))) * MIX[k] + h[k : n + k]
    return np.unique(out * MIX[0])


def signature(found: np.ndarray) -> np.ndarray:
    """Minimum hashes (32 bits); the set is taken in bounded parts."""
    out = np.full(HASHES, 2**32 - 1, np.uint64)
    for i in range(0, len(found), 2048):
        values = found[i : i + 2048, None] * MULTIPLY
        values += ADD
        out = np.minimum(out, (values >> np.uint64(32)).min(axis=0))
    return out.astype(np.uint32)


def sketched(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """run, doc_id, seen (hash of the text), n_shingles, h and i (digest of the set, null if empty), bands, sig."""
    kinds = {"run": pa.int32(), "doc_id": pa.int64(), "seen": pa.int64(), "n_shingles": pa.int64(), "h": pa.int64(), "i": pa.int64(), "bands": pa.list_(pa.int64()), "sig": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(3).cast(pa.large_binary()):
                found = shingles(text.as_py(), width)
                if not len(found):
                    rows.append((0, None, None, [], None))
                    continue
                digest = xxhash.xxh3_128_digest(found.tobytes())
                sig = signature(found)
                cut = sig.reshape(BANDS, ROWS)
                rows.append((len(found), int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True), [xxhash.xxh3_64_intdigest(cut[b].tobytes(), seed=b) - 2**63 for b in range(BANDS)], sig.astype(np.uint8).tobytes()))
            made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), list(kinds.values())[3:], strict=True)] if rows else [pa.array([], t) for t in list(kinds.values())[3:]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=list(kinds))

    light = docs.select(F.spark_partition_id().alias("run"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("seen"), F.col(text_col).alias("text"))
    return light.mapInArrow(run, "run int, doc_id long, seen long, n_shingles long, h long, i long, bands array<long>, sig binary")


def least_matches(threshold: float, miss: float) -> list[int]:
    """For 1, 2, ... batches: matches needed so that P(similarity >= threshold | matches) is at least miss.

    Signatures are compared by their last 8 bits, which agree by chance once in 256; with a uniform prior the
    posterior is a Beta distribution, whose tail for whole parameters is a sum of binomial terms.
    """
    t = threshold + (1 - threshold) / 256
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def left_over(sigs: np.ndarray, sizes: np.ndarray, x: int, rest: np.ndarray, percent: int, needed: list[int]) -> np.ndarray:
    """Those of rest that may reach the threshold with x, by their sizes and batch by batch by their signatures; the likest first."""
    small, large = np.minimum(sizes[rest], sizes[x]), np.maximum(sizes[rest], sizes[x])
    rest = rest[100 * small >= percent * large]
    matches = np.zeros(len(rest), np.int64)
    for k, least in enumerate(needed):
        if not len(rest):
            break
        at = slice(k * BATCH, (k + 1) * BATCH)
        matches += (sigs[rest, at] == sigs[x, at]).sum(axis=1)
        rest, matches = rest[matches >= least], matches[matches >= least]
    return rest[np.lexsort((-rest, -matches))]  # of those alike the nearest, so that no row is in very many pairs


def others(cls: np.ndarray, part: np.ndarray, x: int) -> np.ndarray:
    """Rows before x of other classes; with two blocks, those of the other block."""
    free = cls[:x] != cls[x]
    return np.flatnonzero(free & (part[:x] != part[x]) if part.min() != part.max() else free)


def forest(sigs: np.ndarray, sizes: np.ndarray, cls: np.ndarray, part: np.ndarray, percent: int, needed: list[int], settled: bool) -> list[tuple[int, int]]:
    """Pairs of two classes that signatures leave over, as few as connect all that they connect.

    settled: classes that a pair connects count as one from then on, so that what is left between them is not looked at.
    """
    tree, pairs = cls.copy() if settled else np.arange(len(sigs)), []
    for x in range(1, len(sigs)):
        for y in left_over(sigs, sizes, x, others(tree if settled else cls, part, x), percent, needed):
            if tree[y] != tree[x]:
                pairs.append((int(y), x))
                tree[tree == tree[x]] = tree[y]
    return pairs


def connecting(sets: list[np.ndarray], sigs: np.ndarray, cls: np.ndarray, part: np.ndarray, percent: int, needed: list[int]) -> list[tuple[int, int]]:
    """Verified links that connect classes. part: 0 and 1 for the two blocks compared, or all alike for one block with itself."""
    sizes = np.array([len(s) for s in sets])
    known, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    cls, mark, links = cls.copy(), np.zeros(len(known), bool), []
    for x in range(1, len(sets)):
        rest = left_over(sigs, sizes, x, others(cls, part, x), percent, needed)
        if not len(rest):
            continue
        own = flat[starts[x] : starts[x] + sizes[x]]
        mark[own] = True
        common = np.array([np.count_nonzero(mark[flat[starts[y] : starts[y] + sizes[y]]]) for y in rest])
        mark[own] = False
        for y in rest[100 * common >= percent * (sizes[rest] + sizes[x] - common)]:
            if cls[y] != cls[x]:
                links.append((int(y), x))
                cls[cls == cls[x]] = cls[y]
    return links


def classes_of(group: pd.DataFrame) -> np.ndarray:
    """A number for each class of a group's rows."""
    return group.groupby(["root_h", "root_i"], sort=False).ngroup().to_numpy()


def signatures_of(group: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(group["sig"]), np.uint8).reshape(len(group), HASHES)


LINKS = "ah long, ai long, bh long, bi long"


def pairs_of(group: pd.DataFrame, pairs: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    keys = list(zip(group["h"].tolist(), group["i"].tolist(), strict=True))
    return [(*keys[a], *keys[b]) for a, b in pairs]


def first_pairs(rows: DataFrame, percent: int, needed: list[int]) -> DataFrame:
    """rows: spread, band, block, h, i, n, sig. A forest of the pairs left over in each block of each bucket."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in pdf.groupby(["band", "block"], sort=False):
            if len(group) > 1:
                out += pairs_of(group, forest(signatures_of(group), group["n"].to_numpy(), np.arange(len(group)), np.zeros(len(group), np.int8), percent, needed, True))
        return pd.DataFrame(out, columns=["ah", "ai", "bh", "bi"])

    return rows.groupBy("spread").applyInPandas(run, LINKS)


def still_open(rows: DataFrame, percent: int, needed: list[int], settled: bool) -> DataFrame:
    """rows: spread, band, one, other, side, h, i, n, sig, root_h, root_i. A forest of the pairs left over between classes.

    settled: classes that a pair connects count as one from then on.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in pdf.groupby(["band", "one", "other"], sort=False):
            if len(group) > 1:
                out += pairs_of(group, forest(signatures_of(group), group["n"].to_numpy(), classes_of(group), group["side"].to_numpy(), percent, needed, settled))
        return pd.DataFrame(out, columns=["ah", "ai", "bh", "bi"])

    return rows.groupBy("spread").applyInPandas(run, LINKS).distinct()


def last_links(texts: DataFrame, width: int, percent: int, needed: list[int]) -> DataFrame:
    """texts: spread, band, one, other, side, h, i, root_h, root_i, text. Verified links between classes."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in pdf.groupby(["band", "one", "other"], sort=False):
            if len(group) > 1:
                sets = [shingles(t.encode(), width) for t in group["text"]]
                sigs = np.array([signature(s) for s in sets]).astype(np.uint8)
                out += pairs_of(group, connecting(sets, sigs, classes_of(group), group["side"].to_numpy(), percent, needed))
        return pd.DataFrame(out, columns=["ah", "ai", "bh", "bi"])

    return texts.groupBy("spread").applyInPandas(run, LINKS)


def verified(pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """pairs with text_a and text_b: those whose sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(4).cast(pa.large_binary()), batch.column(5).cast(pa.large_binary()), strict=True):
                a, b = shingles(a.as_py(), width), shingles(b.as_py(), width)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["ah", "ai", "bh", "bi"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("ah", "ai", "bh", "bi", "text_a", "text_b").mapInArrow(run, LINKS)


def linked(links: DataFrame) -> DataFrame:
    """Links as two structs."""
    return links.select(F.struct(F.col("ah").alias("h"), F.col("ai").alias("i")).alias("a"), F.struct(F.col("bh").alias("h"), F.col("bi").alias("i")).alias("b"))


def small(df: DataFrame) -> DataFrame:
    """A written table, marked for a broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_CANDIDATES else df


def in_cells(rows: DataFrame, blocks: str) -> DataFrame:
    """rows (band, h, i) once for each pair of blocks that their own is in: one, other, and side (0 or 1) in it."""
    own = F.pmod(F.xxhash64("h", "i", "band"), F.col(blocks)).cast("int")
    to = rows.withColumn("block", own).withColumn("to", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
    return to.withColumns({"one": F.least("block", "to"), "other": F.greatest("block", "to"), "side": (F.col("block") > F.col("to")).cast("int")}).drop("block", "to")


def spread(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """rows with a number that keeps groups by keys together, in so many tasks that each has about n / ROWS_A_TASK of them."""
    return rows.withColumn("spread", F.pmod(F.xxhash64(*keys), F.lit(max(16, -(-n // ROWS_A_TASK)))))


def near_links(nodes: DataFrame, texts: DataFrame, width: int, percent: int, miss: float) -> DataFrame:
    """Verified links (ah, ai, bh, bi) between nodes. nodes: h, i, doc_id, seen, n, bands, sig; texts: doc_id, seen, text."""
    needed, key = least_matches(percent / 100, miss), F.xxhash64("h", "i")
    keys = nodes.select("h", "i", F.explode("bands").alias("band"))
    buckets = keys.groupBy("band").agg(F.count("*").alias("size"), F.sum(key.cast("decimal(20,0)")).alias("sum"), F.bit_xor(key).alias("xor")).filter("size > 1")
    buckets = buckets.groupBy("size", "sum", "xor").agg(F.min("band").alias("band")).select("band", F.ceil(F.col("size") / BLOCK_DOCS).cast("int").alias("blocks"))
    buckets = written(buckets, "near-buckets")
    members = written(keys.join(small(buckets), "band"), "near-members")
    of_node = nodes.select("h", "i", "n", "sig")

    # Forests of what signatures leave over; `band` is a bucket.
    rows = members.join(of_node, ["h", "i"]).withColumn("block", F.pmod(key.bitwiseXOR(F.col("band")), F.col("blocks")))
    pairs = written(first_pairs(spread(rows, members.count(), "band", "block"), percent, needed).distinct(), "near-pairs")
    large = members.filter("blocks > 1")
    if n_large := large.count():
        cells = between_classes(large, n_large, classes_from(pairs), False)
        pairs = pairs.unionByName(written(still_open(cells.join(of_node, ["h", "i"]), percent, needed, True), "near-more-pairs"))

    # Groups with their texts; `band` is a group from here on.
    place = nodes.select("h", "i", "n", "doc_id", "seen")
    groups = in_groups(classes_from(pairs), place)
    own = groups.withColumn("one", F.pmod(F.xxhash64("h", "i", "band"), F.col("blocks")).cast("int")).withColumns({"other": F.col("one"), "side": F.lit(0), "root_h": F.col("h"), "root_i": F.col("i")})
    links = written(last_links(with_text(by_shingles(own), texts), width, percent, needed), "near-links")
    large = groups.filter("blocks > 1").select("band", "h", "i", "blocks")
    n_large = large.count()
    if not n_large:
        return links
    cells = between_classes(large, n_large, classes_from(links), True)
    pairs = still_open(cells.join(of_node, ["h", "i"]), percent, needed, True)
    links = links.unionByName(written(verified(with_both_texts(pairs, place, texts), width, percent), "near-more-links"))
    classes = classes_from(links)
    cells = between_classes(large, n_large, classes, True)
    left = in_groups(classes_from(still_open(cells.join(of_node, ["h", "i"]), percent, needed, False)), place)
    cells = in_cells(left.join(classes, ["h", "i"], "left").withColumns({f"root_{c}": F.coalesce(f"root_{c}", c) for c in "hi"}), "blocks")
    return links.unionByName(last_links(with_text(by_shingles(cells), texts), width, percent, needed))


def classes_from(pairs: DataFrame) -> DataFrame:
    """h, i, root_h, root_i of the nodes in the components of pairs; written."""
    pairs = written(pairs, "near-edges")
    n = pairs.count()
    found = components(linked(pairs), n)
    return written(found.select(F.col("node.h").alias("h"), F.col("node.i").alias("i"), F.col("root.h").alias("root_h"), F.col("root.i").alias("root_i")), "near-roots", 2 * n)


def between_classes(rows: DataFrame, n: int, classes: DataFrame, apart: bool) -> DataFrame:
    """Of n rows (band, h, i, blocks) those of the bands that have several classes, in cells and with spread and root. apart: only cells of two blocks."""
    placed = rows.join(classes, ["h", "i"], "left").select("band", "h", "i", "blocks", *[F.coalesce(f"root_{c}", c).alias(f"root_{c}") for c in "hi"])
    root = F.struct("root_h", "root_i")
    several = written(placed.groupBy("band").agg((F.min(root) != F.max(root)).alias("several")).filter("several").select("band"), "near-several", n)
    placed = written(placed.join(small(several), "band"), "near-placed", n)
    cells = in_cells(placed, "blocks")
    return spread(cells.filter("one <> other") if apart else cells, placed.count(), "band", "one", "other")


def in_groups(classes: DataFrame, place: DataFrame) -> DataFrame:
    """band (a number for each class), h, i, n, doc_id, seen and blocks: how many the class is dealt into."""
    n = classes.count()
    rows = written(classes.select("h", "i", F.xxhash64("root_h", "root_i").alias("band")).join(place, ["h", "i"]), "near-grouped", n)
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = written(rows.groupBy("band").agg(blocks.alias("blocks")), "near-sizes", n)
    return rows.join(small(sizes), "band")


def by_shingles(cells: DataFrame) -> DataFrame:
    """cells with a spread by which a task has about BLOCK_SHINGLES."""
    n = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return spread(cells, n * ROWS_A_TASK // BLOCK_SHINGLES, "band", "one", "other")


def with_both_texts(pairs: DataFrame, place: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs with text_a and text_b."""
    pairs = written(pairs, "near-class-pairs")
    wanted = pairs.selectExpr("explode(array(struct(ah AS h, ai AS i), struct(bh AS h, bi AS i))) AS k").select("k.h", "k.i").distinct()
    found = written(with_text(wanted.join(place, ["h", "i"]), texts), "near-texts")
    for end in "ab":
        pairs = pairs.join(found.select(F.col("h").alias(f"{end}h"), F.col("i").alias(f"{end}i"), F.col("text").alias(f"text_{end}")), [f"{end}h", f"{end}i"])
    return pairs


def with_text(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """rows (doc_id, seen) with the text they were seen in, once each: repeated documents are left out."""
    once = texts.withColumnsRenamed({"doc_id": "_id", "seen": "_seen"})
    wanted = written(rows.select("doc_id", "seen").distinct(), "near-wanted", rows.count())
    found = once.join(small(wanted), (F.col("seen") == F.col("_seen")) & F.col("doc_id").eqNullSafe(F.col("_id"))).groupBy("doc_id", "seen").agg(F.first("text").alias("text"))
    found = found.withColumnsRenamed({"doc_id": "_id", "seen": "_seen"})
    return rows.join(found, (F.col("seen") == F.col("_seen")) & F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id", "_seen")


def near_classes(docs: DataFrame, width: int = 5, percent: int = 80, miss: float = 1e-4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest identifier of the class), kept.

    percent: least similarity of a link in hundredths. miss: posterior chance under which a candidate pair is dropped.
    """
    all_docs = written(sketched(docs, width, id_col, text_col), "near-sketches")
    from_doc = F.min(F.struct("doc_id", "seen"))
    nodes = all_docs.filter("n_shingles > 0").groupBy("h", "i").agg(from_doc.alias("from"), F.min("doc_id").alias("least"), F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n"))
    nodes = written(nodes.select(F.spark_partition_id().alias("run"), "h", "i", "from.doc_id", "from.seen", "least", "n", "bands", "sig"), "near-nodes")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("seen"), F.col(text_col).alias("text"))
    classes = classes_from(near_links(nodes.drop("run", "least"), texts, width, percent, miss)).select("h", "i", F.struct(F.col("root_h").alias("h"), F.col("root_i").alias("i")).alias("root"))

    own = written(nodes.select("run", "h", "i", "least").join(small(classes), ["h", "i"], "left").withColumn("root", F.coalesce("root", F.struct("h", "i"))), "near-own", nodes.count())
    best = written(own.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("k")).filter("k > 1").drop("k"), "near-best", classes.count())
    of_node = by_run(own, ["root"], best, "left").select("h", "i", F.coalesce("component_id", "least").alias("component_id"))
    rows = by_run(all_docs.select("run", "doc_id", "n_shingles", "h", "i"), ["h", "i"], of_node, "left")
    rows = rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are their class's smallest identifier, all columns."""
    stays = unused("_stays", docs)
    kept = near_classes(docs, width, percent, id_col=id_col, text_col=text_col).filter("kept").select(F.col("doc_id").alias(stays)).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col(stays)), "left_semi")
