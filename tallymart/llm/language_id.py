"""Language identification by segmentation-marginalised unigrams.

For each language there is a probability for each piece of a fixed public vocabulary. The probability
of a word is the sum, over all ways to cut it into pieces, of the product of their probabilities; a
forward pass over the word's positions adds all of them up. The piece probabilities are learned by
expectation-maximisation over the training words of a language: the same forward pass and a backward
pass give the expected number of each piece.

Words are the ASCII-lower-cased `[^\\x20\\x09-\\x0D]+` as UTF-8 bytes after a space, whole at any length:
both passes are scaled as they go along, so that no probability of a long word leaves the range of the numbers. All languages have the same weight
beforehand. The likelihood of a text is taken to the power of one by its number of words before the languages are compared, or
every text of some length would have a score of one: the score is the best language's share of these mean likelihoods of a word.

Defined cases: a text that is null or without a letter is `und` with score 0, and so is every text when
nothing could be learned. Rows with null language are scored but not learned from. Equal likelihoods go to the
smaller language name. Repeated rows are scored alike (and learned from as often as they occur);
empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import written
from tallymart.llm.piece_counts import rank_file_vocabulary
from tallymart.llm.word_counts import fold, word_counts

LETTER, LATIN = regex.compile(r"\p{L}"), re.compile(rb"[A-Za-z]")
#: Words a worker remembers, and numbers (one a word and language) at most; words looked up at once, and new ones scored at
#: once, with their positions (one longer word goes alone).
REMEMBERED, NUMBERS, AT_ONCE, TOGETHER, CELLS = 300_000, 2_000_000, 100_000, 2_000, 130_000
#: Every so many positions a pass is scaled up where it is below LOW; positions whose pieces are held at once in training.
EVERY, LOW, SPAN = 8, 1e-100, 1024


class Pieces:
    """The pieces of a vocabulary as a table of transitions, and where they lie in blocks of words.

    A trie in a double array: the node reached from `node` by a byte is base[node] + byte, if it names `node` as its
    owner. About as many cells as nodes, so the table is under a megabyte and travels with the model.
    """

    def __init__(self, vocabulary: list[bytes]) -> None:
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        self.size, self.longest = len(vocabulary), 1
        for k, text in enumerate(vocabulary):
            if text.lower() != text:  # words are lower-cased: these are nowhere
                continue
            node = 0
            for byte in text:
                nxt = children[node].get(byte)
                if nxt is None:
                    nxt = children[node][byte] = len(children)
                    children.append({})
                    ends.append(-1)
                node = nxt
            ends[node] = k
            self.longest = max(self.longest, len(text))
        # Nodes with many children first: each takes the first place where the cells of all its children are free.
        used, cell, base_of = bytearray(len(children) + 512), [0] * len(children), [0] * len(children)
        used[0] = 1
        begin: dict[int, int] = {}  # by number of children: places before have been tried in vain
        for node in sorted(range(len(children)), key=lambda n: -len(children[n])):
            own = sorted(children[node])
            if not own:
                break
            at = max(begin.get(len(own), 1), own[0] + 1)
            while True:
                at = used.find(0, at)
                if at < 0 or at + 256 > len(used):
                    used.extend(bytes(len(used)))
                    at = used.find(0, max(1, at))
                if not any(used[at - own[0] + c] for c in own):
                    break
                at += 1
            begin[len(own)] = max(begin.get(len(own), 1), at - own[0])
            base_of[node] = at - own[0]
            for c in own:
                used[at - own[0] + c] = 1
                cell[children[node][c]] = at - own[0] + c
        cells = used.rfind(1) + 257
        self.base, self.owner, self.piece = np.zeros(cells, np.int32), np.full(cells, -1, np.int32), np.full(cells, -1, np.int32)
        self.base[cell], self.piece[cell] = base_of, ends
        for node, c in enumerate(children):
            self.owner[[cell[x] for x in c.values()]] = cell[node]

    def follow(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes reached, 0 where there is none."""
        to = self.base.take(node) + byte
        return np.where(self.owner.take(to) == node, to, 0)

    def hits(self, words: list[bytes], first: int = 0, last: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Start (from first, before last), end, words and pieces; by start. All words go through the table together, a byte at a time."""
        sizes = np.array([len(w) for w in words])
        width = int(sizes.max())
        text = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(len(words), width)
        for start in range(first, width if last is None else min(last, width)):
            at = np.flatnonzero(sizes > start)
            node = np.zeros(len(at), np.int32)
            for end in range(start, min(width, start + self.longest)):
                node = self.follow(node, text[at, end])
                on = (node > 0) & (sizes[at] > end)
                at, node = at[on], node[on]
                if not len(at):
                    break
                piece = self.piece[node]
                here = piece >= 0
                yield start, end + 1, at[here], piece[here]


def scaled_up(rows: list[np.ndarray], log: np.ndarray) -> None:
    """Rows of one scale: where they are all below LOW their greatest becomes 1, and its logarithm goes to log."""
    top = rows[0].copy()
    for r in rows[1:]:
        np.maximum(top, r, out=top)
    low = (top < LOW) & (top > 0)
    if low.any():
        top[~low] = 1
        log += np.log(top)
        for r in rows:
            r /= top


def forward(words: list[bytes], hits: Iterator[tuple], p: Callable[[np.ndarray, np.ndarray], np.ndarray], columns: int, ready: Callable | None = None, rows: int | None = None) -> np.ndarray:
    """at[position, word, k]: probability of the bytes before the position, over all ways to cut them, times exp(-log[word, k]).

    Scaling is for each word and column, of all positions that pieces have come to, so that what is added up has one scale; log stays 0
    as long as nothing falls below LOW. ready(position, at[position], log) is called for each position when it is complete. With
    `rows` (more than the longest piece has bytes) only so many positions are held, in turn.
    """
    width = max(map(len, words))
    rows = min(rows or width + 1, width + 1)
    at = np.zeros((rows, len(words), columns))
    at[0] = 1
    log, here, reach = np.zeros((len(words), columns)), -1, 0

    def come(position: int) -> None:
        nonlocal here
        while here < position:
            if here >= 0 and rows <= width:
                at[here % rows] = 0
            here += 1
            if here and here % EVERY == 0 and reach >= here:
                scaled_up([at[k % rows] for k in range(here, reach + 1)], log)
            if ready is not None:
                ready(here, at[here % rows], log)

    for start, end, b, piece in hits:
        come(start)
        reach = max(reach, end)
        add = at[start % rows].take(b, axis=0)
        add *= p(b, piece)
        add += at[end % rows].take(b, axis=0)
        at[end % rows][b] = add
    come(width)
    return at


def log_likelihoods(words: list[bytes], pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """Log probability of each word under each column of probability."""
    sizes, out = np.array([len(w) for w in words]), np.empty((len(words), probability.shape[1]))

    def ready(position: int, values: np.ndarray, log: np.ndarray) -> None:
        ended = np.flatnonzero(sizes == position)
        if len(ended):
            out[ended] = np.log(values[ended]) + log[ended]

    forward(words, pieces.hits(words), lambda _, piece: probability.take(piece, axis=0), probability.shape[1], ready, pieces.longest + 1)
    return out


def expected(words: list[bytes], pieces: Pieces, probability: np.ndarray, column: np.ndarray, weight: np.ndarray, n_columns: int) -> np.ndarray:
    """Expected number of each piece; a word belongs to the language column[word] and counts weight[word] times.

    Pieces are found once for words of up to SPAN bytes, and again for the way back, span by span, for longer ones.
    """
    rows, sizes = np.arange(len(words)), np.array([len(w) for w in words])
    width = int(sizes.max())
    held = list(pieces.hits(words)) if width <= SPAN else None
    p = lambda b, piece: probability[piece, column[b]][:, None]
    ahead = np.empty((width + 1, len(words)))  # logarithms

    def ready(position: int, values: np.ndarray, log: np.ndarray) -> None:
        with np.errstate(divide="ignore"):
            ahead[position] = np.log(values[:, 0]) + log[:, 0]

    forward(words, pieces.hits(words) if held is None else iter(held), p, 1, ready, pieces.longest + 1)
    total = ahead[sizes, rows]
    total[total == -np.inf] = np.inf  # no way to cut it: nothing is expected
    behind, log, scaled = np.zeros_like(ahead), np.zeros(len(words)), width
    behind[sizes, rows] = 1
    out = np.zeros(pieces.size * n_columns)
    for first in range((width - 1) // SPAN * SPAN, -1, -SPAN):
        where, shares, now = [], [], -1
        for start, end, b, piece in reversed(held or list(pieces.hits(words, first, first + SPAN))):
            if start != now:
                now = start
                if scaled - start >= EVERY:
                    scaled = start
                    scaled_up([behind[k] for k in range(start + 1, min(width, start + pieces.longest) + 1)], log)
                times = weight * np.exp(np.minimum(ahead[start] + log - total, 700))
            after = behind[end].take(b) * probability[piece, column[b]]
            behind[start][b] += after
            where.append(piece.astype(np.int64) * n_columns + column[b])
            shares.append(times.take(b) * after)
        if where:
            out += np.bincount(np.concatenate(where), np.concatenate(shares), len(out))
    return out.reshape(-1, n_columns)


def together(words: list[bytes]) -> Iterator[slice]:
    """Slices of words, sorted by length, that share a table of positions."""
    first = 0
    for k, w in enumerate(words):
        if k > first and (k - first >= TOGETHER or (k - first + 1) * (len(w) + 2) > CELLS):
            yield slice(first, k)
            first = k
    if words:
        yield slice(first, len(words))


class Model:
    """Languages, pieces and probability[piece, language]: as large as the vocabulary times the languages."""

    def __init__(self, languages: list[str], probability: np.ndarray, pieces: Pieces) -> None:
        self.languages, self.probability, self.pieces, self.key = languages, probability, pieces, uuid.uuid4().hex


def learned(docs: DataFrame, vocabulary_path: str, lang: str = "lang", rounds: int = 2, smoothing: float = 0.5) -> Model:
    """The model of all given documents with a language.

    The texts are read once, into a table of words with their number in each language; the rounds of
    expectation-maximisation run over that table, and the driver gets one number for each piece and
    language.
    """
    table = written(word_counts(docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), "text"), "lang"), "lang-words")
    languages = sorted(r[0] for r in table.select("grp").distinct().collect())
    pieces = Pieces(rank_file_vocabulary(vocabulary_path))
    probability = np.full((pieces.size, max(1, len(languages))), 1 / pieces.size)
    place = {x: i for i, x in enumerate(languages)}
    for _ in range(rounds if languages else 0):
        held = docs.sparkSession.sparkContext.broadcast((pieces, probability))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            pieces, current = held.value
            out = np.zeros(current.shape)
            for batch in batches:
                rows = sorted(zip(*(c.to_pylist() for c in batch.columns), strict=True), key=lambda r: len(r[1]))
                words = [b" " + word for _, word, _ in rows]
                for part in together(words):
                    column, weight = np.array([place[g] for g, _, _ in rows[part]]), np.array([n for _, _, n in rows[part]], float)
                    out += expected(words[part], pieces, current, column, weight, out.shape[1])
            piece, k = np.nonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(k), pa.array(out[piece, k])], names=["piece", "k", "n"])

        got = table.mapInArrow(run, "piece long, k long, n double").groupBy("piece", "k").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full(probability.shape, smoothing)
        counts[got["piece"], got["k"]] += got["n"]
        probability = counts / counts.sum(axis=0)
    return Model(languages, probability, pieces)


class Scorer:
    """Log likelihoods of words under each language, remembered."""

    def __init__(self, model: Model) -> None:
        self.model, self.place = model, {}
        self.room = max(2 * TOGETHER, min(REMEMBERED, NUMBERS // max(1, len(model.languages))))
        self.logs = np.zeros((self.room, len(model.languages)))

    def learn(self, words: list[bytes]) -> None:
        first = len(self.place)
        self.place.update(zip(words, range(first, first + len(words)), strict=True))
        self.logs[first : first + len(words)] = log_likelihoods([b" " + w for w in words], self.model.pieces, self.model.probability)

    def totals(self, parts: list[list[bytes]]) -> np.ndarray:
        """Log likelihood of each list of words under each language; not more words than there is room for, none empty."""
        words = [w for part in parts for w in part]
        new = set(words) - self.place.keys()
        if len(self.place) + len(new) > self.room:
            self.place.clear()
            new = set(words)
        new = sorted(new, key=len)
        for part in together(new):  # words of like length share a table of positions
            self.learn(new[part])
        at = np.fromiter(map(self.place.__getitem__, words), np.int32, len(words))
        return np.add.reduceat(self.logs.take(at, axis=0), np.cumsum([0, *map(len, parts[:-1])]))

    def verdicts(self, texts: Iterator[bytes | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text. A long text is taken in parts."""
        languages, step = self.model.languages, min(AT_ONCE, self.room)
        names, scores, waiting, owner, n = [], [], [], [], 0
        totals: list[np.ndarray] = []
        sizes: list[int] = []

        def settle() -> None:
            if waiting:
                for k, part in zip(owner, self.totals(waiting), strict=True):
                    totals[k] = totals[k] + part
            waiting.clear(), owner.clear()

        for k, text in enumerate(texts):
            words = text.lower().split() if languages and text and has_letter(text) else []
            totals.append(np.zeros(len(languages)))
            sizes.append(len(words))
            for i in range(0, len(words), step):
                part = words[i : i + step]
                if n + len(part) > step:
                    settle()
                    n = 0
                waiting.append(part)
                owner.append(k)
                n += len(part)
        settle()
        for total, size in zip(totals, sizes, strict=True):
            if not size:
                names.append("und"), scores.append(0.0)
                continue
            best = int(np.argmax(total))
            names.append(languages[best])
            scores.append(float(1 / np.exp(np.maximum((total - total[best]) / size, -700)).sum()))
        return names, scores


def has_letter(text: bytes) -> bool:
    return LATIN.search(text) is not None or (not text.isascii() and LETTER.search(text.decode("utf-8", "replace")) is not None)


_scorers: dict[str, Scorer] = {}


def scorer_for(model: Model) -> Scorer:
    if model.key not in _scorers:
        _scorers.clear()
        _scorers[model.key] = Scorer(model)
    return _scorers[model.key]


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about AT_ONCE words, so that a worker never takes apart all texts of a batch at once."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.flatnonzero(np.diff(np.cumsum(sizes) // (6 * AT_ONCE))) + 1
    for first, last in zip([0, *ends], [*ends, batch.num_rows], strict=True):
        yield batch.slice(first, last - first)


def text_bytes(column: pa.Array) -> Iterator[bytes | None]:
    return (x.as_py() for x in column.cast(pa.large_binary()))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """docs, whose last column is the text, with lang_pred and score in its place."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    *names, text = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_for(held.value)
        for batch in batches:
            for part in slices(batch, len(names)):
                found, scores = scorer.verdicts(text_bytes(part.column(len(names))))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    return docs.mapInArrow(run, docs.drop(text).schema.add("lang_pred", "string").add("score", "double"))


def identified(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The documents with a language and a score of at least `least`, all columns. Rows pass through Python in Arrow batches, whole."""
    held, column = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_for(held.value)
        for batch in batches:
            for part in slices(batch, column):
                found, scores = scorer.verdicts(text_bytes(part.column(column)))
                yield part.filter(pa.array([name != "und" and score >= least for name, score in zip(found, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def language_model(docs: DataFrame, vocabulary_path: str, modulus: int = 3, held: int = 1) -> Model:
    """Learned from the documents outside the held-out fold."""
    return learned(docs.filter(fold(F.col("doc_id"), modulus) != held).select("lang", "text"), vocabulary_path)


def language_id(docs: DataFrame, vocabulary_path: str, modulus: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each document."""
    model = language_model(docs, vocabulary_path, modulus, held)
    return predicted(docs.select("doc_id", (fold(F.col("doc_id"), modulus) == held).alias("held_out"), "text"), model)
