"""Word-piece counts by a linear longest-match automaton.

A word is cut greedily into the longest vocabulary pieces. The vocabulary is a trie whose nodes also
hold a failure link and the number of pieces that are settled when it is followed: at a node for the
string s, following the link means that the longest pieces at the front of s are done, and the link
leads to the node for what remains of s. A word of n bytes thus costs O(n), no piece is built, and
only the numbers are added up.

Words are `[^\\x20\\x09-\\x0D]+`; each is matched as its UTF-8 bytes after one space, so pieces that
begin with a space are those that begin a word. The vocabulary has every single byte, so every word
can be cut.

Defined cases: a null or empty text has 0 words and 0 pieces. Very long words are matched whole. Rows
are independent: repeated rows give repeated results, an empty table an empty one. Only the two named
columns are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Words whose counts a worker remembers at once, and the longest of them in bytes.
REMEMBERED, LONGEST = 400_000, 48


class Automaton:
    """Trie over byte strings with failure links. Every single byte must be in the vocabulary."""

    def __init__(self, vocabulary: list[bytes]) -> None:
        children: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in vocabulary:
            node = 0
            for byte in piece:
                nxt = children[node].get(byte)
                if nxt is None:
                    nxt = children[node][byte] = len(children)
                    children.append({})
                    ends.append(False)
                node = nxt
            ends[node] = node > 0
        link, popped = [0] * len(children), [0] * len(children)
        level = [0]
        while level:
            deeper = []
            for parent in level:
                for byte, node in children[parent].items():
                    deeper.append(node)
                    if ends[node]:
                        popped[node] = 1  # the string itself is a piece; nothing remains
                        continue
                    at, n = link[parent], popped[parent]
                    while byte not in children[at]:
                        n += popped[at]
                        at = link[at]
                    link[node], popped[node] = children[at][byte], n
            level = deeper
        self.children, self.link, self.popped = children, link, popped

    def count(self, word: bytes) -> int:
        children, link, popped = self.children, self.link, self.popped
        node = n = 0
        for byte in word:
            nxt = children[node].get(byte)
            while nxt is None:
                n += popped[node]
                node = link[node]
                nxt = children[node].get(byte)
            node = nxt
        while node:
            n += popped[node]
            node = link[node]
        return n


class Counts(dict):
    """Pieces of a word, remembered for short words."""

    def __init__(self, automaton: Automaton) -> None:
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(b" " + word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n


def rank_file_vocabulary(path: str) -> list[bytes]:
    """Pieces of a public rank file: base64 and rank on each line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


_counts: dict[str, Counts] = {}


def counts_for(path: str) -> Counts:
    """One automaton for each worker process and vocabulary."""
    if path not in _counts:
        _counts[path] = Counts(Automaton(rank_file_vocabulary(path)))
    return _counts[path]


def piece_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_words, n_pieces, n_bytes for each document; a narrow step without any shuffle.

    vocabulary_path: a rank file that is installed at the same place on every machine.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counts_for(vocabulary_path)
        for batch in batches:
            words, pieces, sizes = [], [], []
            for text in batch.column(1).cast(pa.large_binary()):
                text = text.as_py() or b""
                found = text.split()
                words.append(len(found))
                pieces.append(sum(map(counts.__getitem__, found)))
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(pieces, pa.int64()), pa.array(sizes, pa.int64())], names=[id_col, "n_words", "n_pieces", "n_bytes"])

    light = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS `{id_col}`", f"`{text_col}` AS text")
    return light.mapInArrow(count, f"`{id_col}` long, n_words long, n_pieces long, n_bytes long")
