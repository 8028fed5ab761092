"""Ranked lexical search by dual trees: items and documents in hierarchies with coordinate maxima, pairs of nodes pruned by bounds.

1. One pass over the documents counts terms; of each document its length and the counts of terms that items hold are written.
2. A pass over that table gives the number of documents, their length and in how many each term is, hence the weights.
3. Items are in batches, each a tree: items, groups of items alike, the root; a node has for each term the largest coefficient
   below it. A task takes its documents in batches, each a tree too: leaves of a few documents, sorted by the group of items that
   they fit best, nodes of leaves, the root; a node has for each term the largest impact below it. The inner product of two nodes'
   maxima bounds every score below the pair; where it is less than the weakest k-th score of the node's items, the pair is left out
   with all below it: root and root, group and node, item and leaf. What is left is scored exactly, an item's best leaves first, as
   that raises its k-th score.
4. The tasks' lists are merged up a tree.

Scores are whole numbers, so bounds are compared without error and nothing that could be in the result is left out. Items beyond
ITEM_BYTES of text are searched in several passes, so what a task is given of them has a fixed bound; nothing else is broadcast.

Defined cases: a null or empty text has no term; such a document counts nowhere, such an item finds nothing. Repeated rows are
documents and items each. Equal scores go by identifier, a null one last. A null item identifier passes through. Without documents or
items the result is empty. Columns other than those named are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import written
from tallymart.llm.top_lists import TOP, lists, merged

#: A term's letters and digits, A-Z in lower case; every other ASCII character ends a term.
LETTERS = bytes(ord(chr(c).lower()) if chr(c).isalnum() else 0x20 for c in range(128)) + bytes(range(128, 256))
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 20
#: Text of items that one pass searches for.
ITEM_BYTES = 32 << 20
#: Items of a batch and the terms that they hold at most (an item with more is alone); items of a group.
BATCH, BATCH_TERMS, GROUP = 256, 16_384, 8
#: Documents of a batch, at most, and the bytes of their impacts; documents of a leaf; leaves of a node.
DOCS, DOC_BYTES, DOC_LEAF, FANOUT = 2_048, 32 << 20, 8, 8
#: The largest impact of a term.
IMPACT = 1_000_000


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    text, at = text.translate(LETTERS), 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def term_counts(docs: DataFrame, numbers: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (terms with repeats), terms (numbers of those known, ascending), tfs of every document with a term; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ns, keys, counts, ends = [], [], [], [], [0]
            for row, text in enumerate(batch.column(1).cast(pa.large_binary())):
                n, of_doc = 0, []
                for some in terms(text.as_py() or b""):
                    n += len(some)
                    known = np.fromiter((numbers.get(t, -1) for t in some), np.int32, len(some))
                    of_doc.append(np.unique(known[known >= 0], return_counts=True))
                if not n:
                    continue
                if len(of_doc) > 1:
                    totals = np.bincount(np.concatenate([k for k, _ in of_doc]), np.concatenate([c for _, c in of_doc])).astype(np.int64)
                    of_doc = [(np.flatnonzero(totals), totals[totals > 0])]
                rows.append(row), ns.append(n), keys.append(of_doc[0][0]), counts.append(of_doc[0][1]), ends.append(ends[-1] + len(of_doc[0][0]))
            flat = [np.concatenate(x).astype(np.int32) if x else np.empty(0, np.int32) for x in (keys, counts)]
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(ns, pa.int64()), *(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x)) for x in flat)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"])

    light = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return written(light.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>"), "lexical-counts")


def weights(counted: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """(Documents, their length, each term's weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten(), minlength=n_terms)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], names=["term", "df"])

    n, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    w = np.zeros(n_terms, np.int64)
    # A row for each term of the items of a pass.
    for term, df in counted.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        w[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    return n, length, w


@dataclass
class Node:
    """A node of a tree of items: places in the batch's vocabulary and the largest coefficient below the node at each."""

    places: np.ndarray
    coefficients: np.ndarray

    def bounds(self, maxima: np.ndarray) -> np.ndarray:
        """Inner products with the columns of maxima (terms by nodes or documents)."""
        return self.coefficients @ maxima[self.places]


def above(nodes: list[Node]) -> Node:
    """The node over these."""
    places, to = np.unique(np.concatenate([n.places for n in nodes]), return_inverse=True)
    most = np.zeros(len(places), nodes[0].coefficients.dtype)
    np.maximum.at(most, to, np.concatenate([n.coefficients for n in nodes]))
    return Node(places, most)


@dataclass
class Items:
    """A batch of items as a tree: a leaf each, groups of GROUP leaves, the root."""

    numbers: list[int]
    leaves: list[Node]
    vocabulary: np.ndarray
    groups: list[Node] = field(init=False)
    root: Node = field(init=False)

    def __post_init__(self) -> None:
        # Doubles where they hold every score and bound exactly, else whole numbers.
        self.groups = [above(self.leaves[at : at + GROUP]) for at in range(0, len(self.leaves), GROUP)]
        self.root = above(self.groups)
        if int(self.root.coefficients.sum()) * IMPACT < 2**52:
            for n in (*self.leaves, *self.groups, self.root):
                n.coefficients = n.coefficients.astype(np.float64)


def alike(x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """rows in groups, by halves: on a line between two rows far apart."""
    if len(rows) <= GROUP:
        return [rows]
    far = rows[np.argmin(x[rows] @ x[rows[0]])]
    other = rows[np.argmin(x[rows] @ x[far])]
    order = rows[np.argsort(x[rows] @ (x[far] - x[other]), kind="stable")]
    half = -(-len(rows) // (2 * GROUP)) * GROUP
    return [*alike(x, order[:half]), *alike(x, order[half:])]


def batched(found: list[tuple[int, np.ndarray, np.ndarray]], w: np.ndarray) -> list[Items]:
    """Items (number, terms, counts) in batches, alike ones together. A term of weight 0 and an item without any other take no part."""
    found = [(no, t[w[t] > 0], (c * w[t])[w[t] > 0]) for no, t, c in found]
    found = sorted(((no, t, c) for no, t, c in found if len(t)), key=lambda x: (int(x[1][np.argmax(x[2])]), x[0]))
    batches: list[list] = []
    held: set[int] = set()
    for item in found:
        if not batches or len(batches[-1]) == BATCH or len(held.union(item[1].tolist())) > BATCH_TERMS:
            batches.append([])
            held = set()
        batches[-1].append(item)
        held.update(item[1].tolist())
    out = []
    for batch in batches:
        vocabulary = np.unique(np.concatenate([t for _, t, _ in batch]))
        leaves = [Node(np.searchsorted(vocabulary, t), c) for _, t, c in batch]
        directions = np.zeros((len(batch), len(vocabulary)))
        for i, leaf in enumerate(leaves):
            directions[i, leaf.places] = leaf.coefficients / np.linalg.norm(leaf.coefficients.astype(np.float64))
        order = np.concatenate(alike(directions, np.arange(len(batch))))
        out.append(Items([batch[i][0] for i in order], [leaves[i] for i in order], vocabulary))
    return out


class Best:
    """The k best documents of each item so far."""

    def __init__(self, k: int) -> None:
        self.k, self.of = k, {}

    def weakest(self, item: int) -> int:
        """The score that a document needs to come in: the k-th, or 1."""
        got = self.of.get(item)
        return int(got[0][-1]) if got is not None and len(got[0]) == self.k else 1

    def take(self, item: int, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        keep = scores >= self.weakest(item)
        if not keep.any():
            return
        new = scores[keep].astype(np.int64), ids[keep], nameless[keep]
        if item in self.of:
            new = tuple(np.concatenate(x) for x in zip(self.of[item], new, strict=True))
        order = np.lexsort((new[1], new[2], -new[0]))[: self.k]
        self.of[item] = tuple(x[order] for x in new)


def impacts(n: np.ndarray, tfs: np.ndarray, rows: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """What each count is worth in its document."""
    share = 75 * n * n_docs // length if 75 * int(n.max(initial=0)) * n_docs < 2**63 else (75 * n.astype(object) * n_docs // length).astype(np.int64)
    return 1_000_000_000 * tfs // (1000 * tfs + 8 * (25 + share)[rows])


class Search:
    """Dual-tree search of documents, a batch at a time, for the items of a pass."""

    def __init__(self, batches: list[Items], n_docs: int, length: int, k: int) -> None:
        self.n_docs, self.length, self.best = n_docs, length, Best(k)
        self.batches = batches
        self.at_once = max(DOC_LEAF * FANOUT, min([DOCS, *(DOC_BYTES // (8 * len(items.vocabulary)) for items in batches)]))
        # Pairs of an item and a document: all, and those that were scored.
        self.pairs = self.scored = 0

    def documents(self, batch: pa.RecordBatch) -> None:
        """doc_id, n, terms, tfs of at most at_once documents."""
        ids, ns, terms, tfs = batch.columns
        nameless = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        rows = np.repeat(np.arange(len(ids)), np.diff(terms.offsets.to_numpy()))
        terms, tfs = terms.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
        worth = impacts(ns.to_numpy(), tfs, rows, self.n_docs, self.length)
        for items in self.batches:
            self.pairs += len(ids) * len(items.numbers)
            self.pair(items, ids, nameless, rows, terms, worth)

    def pair(self, items: Items, ids: np.ndarray, nameless: np.ndarray, rows: np.ndarray, terms: np.ndarray, worth: np.ndarray) -> None:
        """A batch of documents against a batch of items, from the roots down."""
        place = np.minimum(np.searchsorted(items.vocabulary, terms), len(items.vocabulary) - 1)
        here = items.vocabulary[place] == terms
        rows, place, worth = rows[here], place[here], worth[here].astype(items.root.coefficients.dtype)
        top = np.zeros(len(items.vocabulary), worth.dtype)
        np.maximum.at(top, place, worth)
        if items.root.bounds(top) < min(map(self.best.weakest, items.numbers)):
            return
        # The documents in the order of the group that they fit best, so that those alike are in one leaf.
        towards = np.zeros((len(items.groups), len(items.vocabulary)))
        for g, group in enumerate(items.groups):
            towards[g, group.places] = group.coefficients / np.linalg.norm(group.coefficients.astype(np.float64))
        fit = np.array([np.bincount(rows, worth * t[place], len(ids)) for t in towards])
        nearest = fit.argmax(axis=0)
        order = np.lexsort((-fit[nearest, np.arange(len(ids))], nearest))
        ids, nameless, at = ids[order], nameless[order], np.argsort(order)
        size = -(-len(ids) // (DOC_LEAF * FANOUT)) * DOC_LEAF * FANOUT
        matrix = np.zeros((len(items.vocabulary), size), worth.dtype)
        matrix[place, at[rows]] = worth
        leaves = matrix.reshape(len(matrix), -1, DOC_LEAF).max(axis=2)
        nodes = leaves.reshape(len(matrix), -1, FANOUT).max(axis=2)
        for g, group in enumerate(items.groups):
            below = range(g * GROUP, min((g + 1) * GROUP, len(items.leaves)))
            bounds = group.bounds(nodes)
            near = np.flatnonzero(bounds >= min(self.best.weakest(items.numbers[i]) for i in below))
            if len(near):
                near = (near[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                under = leaves[:, near]
                for i in below:
                    self.leaf(items.numbers[i], items.leaves[i], items.leaves[i].bounds(under), near, matrix, ids, nameless)

    def leaf(self, number: int, item: Node, bounds: np.ndarray, near: np.ndarray, matrix: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        """Score an item's documents leaf by leaf in the order of the bounds of the leaves, until these are under its k-th score."""
        order, done, some = np.argsort(-bounds, kind="stable"), 0, 2
        while done < len(order):
            chosen = order[done : done + some]
            chosen = chosen[bounds[chosen] >= self.best.weakest(number)]
            if not len(chosen):
                return
            docs = (near[chosen][:, None] * DOC_LEAF + np.arange(DOC_LEAF)).ravel()
            docs = docs[docs < len(ids)]
            scores = item.coefficients @ matrix[item.places[:, None], docs]
            self.scored += len(docs)
            self.best.take(number, scores, ids[docs], nameless[docs])
            done, some = done + some, 4 * some


def searched(counted: DataFrame, batches: list[Items], n_docs: int, length: int, k: int) -> DataFrame:
    """no, node, top: each task's lists."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, part = Search(batches, n_docs, length, k), TaskContext.get().partitionId()
        for batch in found:
            for at in range(0, batch.num_rows, search.at_once):
                search.documents(batch.slice(at, search.at_once))
        of = search.best.of
        scores, ids, nameless = (np.concatenate([x[c] for x in of.values()] or [np.empty(0, t)]) for c, t in enumerate((np.int64, np.int64, bool)))
        ends = np.cumsum([0, *(len(x[0]) for x in of.values())])
        columns = [pa.array(list(of), pa.int64()), pa.array(np.full(len(of), part)), lists(scores, pa.array(ids, mask=nameless), ends)]
        yield pa.RecordBatch.from_arrays(columns, names=["no", "node", "top"])

    return counted.mapInArrow(run, f"no long, node long, top {TOP}")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    passes = -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // ITEM_BYTES) or 1
    results: list[DataFrame] = []
    for p in range(passes):
        numbers: dict[bytes, int] = {}
        found, names = [], []
        for no, (item_id, text) in enumerate(asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p).collect()):
            counts = Counter(t for some in terms((text or "").encode()) for t in some)
            found.append((no, np.array([numbers.setdefault(t, len(numbers)) for t in counts], np.int64), np.array(list(counts.values()), np.int64)))
            names.append((no, item_id))
        counted = term_counts(docs, numbers, id_col, text_col)
        n, length, w = weights(counted, len(numbers))
        tops = searched(counted, batched(found, w), n, length, k)
        best = merged(tops, ["no"], max(counted.rdd.getNumPartitions(), 1), k)
        of = spark.createDataFrame(names, "no long, item_id long")
        each = best.join(of, "no").select("item_id", F.posexplode("top").alias("place", "e"))
        results.append(each.select("item_id", (F.col("place") + 1).alias("rank"), F.col("e.id").alias("doc_id"), (-F.col("e.fallen")).alias("score")))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
