"""Language-model scoring by a log-bilinear model trained with noise-contrastive estimation.

Units: the `top` most frequent training tokens stand for themselves, every other token for one of
`rare` units by its last two bytes. Both numbers grow with the corpus (top with the square root of its tokens), and so do the
vectors. Units by falling frequency are cut into classes, small ones first. A context is the two units before; its vector h is the
sum of two matrices times the units' vectors. The probability of a unit is that of its class given h times that of the unit among
its class given h; both are log-bilinear, with vectors and biases of their own.

Training is numpy in the tasks, on shards: documents are dealt out and ordered by a hash of their content, as many shards as the tokens
ask for, so that the model is a function of the rows, not of their partitions. Each shard is gone through once
a round from the common parameters, with noise drawn for each step: classes by their frequency for the first factor, units of the
class by theirs for the second. The shards' parameters are averaged, weighted by tokens, up a tree. The documents are split over
the rounds, so each is learned from once.

Scoring is normalised: batched matrix products of contexts with all classes, and with the units of the class in question.
Within a rare unit a token has (c + 1) / (n + v + 1), c its training count, n and v the
unit's training tokens and distinct tokens; the one over is for tokens never seen. So the
probabilities of all next tokens add up to one.

Tokens: ASCII-lower-cased `[^\\x20\\x09-\\x0D]+`, then one end. The base score takes all training
counts with one added, (c + 1) / (N + V + 1).

The driver and the workers hold the model and `dictionary` words with counts (as many as have units, if these are more). All other
counts stay in a table that is joined to the words of the documents.

Defined cases: a null or empty text is the end alone. Repeated rows are scored alike and learned from as often as
they occur. Without training documents N and V are 0 and every score is that of an unseen token
under the untrained model. A document with null identifier is learned from. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import written
from tallymart.llm.word_counts import fold, word_counts

END = b"\n"  # cannot be a word
LOG10 = np.log(10)
#: Tokens shuffled together in training; of a step; scored at once. Noise classes of a step, noise units of a class in a step. Logits held at once.
CHUNK, STEP, SCORED, NOISE, NOISE_UNITS, LOGITS = 400_000, 16_384, 131_072, 16, 8, 262_144
#: Training tokens of a shard and round, about; shards whose parameters are added up at once.
SHARD_TOKENS, FAN_IN = 2_000_000, 8
#: Partitions that the candidates for the dictionary are gathered in.
CANDIDATE_PARTITIONS = 4


def rare_class(word: bytes, rare: int) -> int:
    return zlib.crc32(word[-2:]) % rare


@dataclass
class Dictionary:
    """The most frequent words with their counts; units by falling frequency; N and V.

    top_units, rare_units: unit of each word with its own, and of each rare group. tokens, words: of each unit.
    """

    counts: dict[bytes, int]
    rare: int
    top_units: np.ndarray
    rare_units: np.ndarray
    tokens: np.ndarray
    words: np.ndarray
    n_tokens: int
    n_words: int
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    @property
    def units(self) -> int:
        return len(self.tokens)

    def index(self) -> np.ndarray:
        """Unit of each dictionary word."""
        top = len(self.top_units)
        return np.array([self.top_units[i] if i < top else self.rare_units[rare_class(w, self.rare)] for i, w in enumerate(self.counts)], np.int32)


class UnitOf(dict):
    def __init__(self, dictionary: Dictionary) -> None:
        super().__init__(zip(dictionary.counts, dictionary.index().tolist(), strict=True))
        self.rare_units = dictionary.rare_units.tolist()

    def __missing__(self, word: bytes) -> int:
        return self.rare_units[zlib.crc32(word[-2:]) % len(self.rare_units)]


def dictionary_of(counts: DataFrame, top: int | None, rare: int | None, dictionary: int) -> Dictionary:
    """counts: word, n. The dictionary's rows and one row for each rare unit come to the driver."""
    # A sort with a limit would send that many rows from every task to the driver. Only words at or above the highest
    # power of two that enough words reach can be among them, so a few partitions hold the candidates.
    steps = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), *[F.count_if(F.col("n") >= 2**k).alias(f"k{k}") for k in range(48)]).first()
    top = math.isqrt(steps["all"]) + 1 if top is None else top
    rare = max(64, math.isqrt(top) + 1) if rare is None else rare
    dictionary = max(dictionary, top)
    floor = 2 ** max([k for k in range(48) if steps[f"k{k}"] >= dictionary], default=0)
    frequent = counts.filter(F.col("n") >= floor).repartition(CANDIDATE_PARTITIONS).orderBy(F.desc("n"), "word").limit(dictionary).collect()
    kept = {bytes(r["word"]): r["n"] for r in frequent}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.fromiter((rare_class(w, rare) for w in batch.column(0).to_pylist()), np.int64, batch.num_rows)
            n = np.bincount(k, batch.column(1).to_numpy(), rare).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rare)), pa.array(n), pa.array(np.bincount(k, minlength=rare))], names=["k", "n", "v"])

    tokens, words = np.zeros(rare, np.int64), np.zeros(rare, np.int64)
    for r in counts.select("word", "n").mapInArrow(sums, "k long, n long, v long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        tokens[r["k"]], words[r["k"]] = r["n"], r["v"]
    total, distinct = int(tokens.sum()), int(words.sum())
    own = list(kept)[:top]
    for w in own:
        tokens[rare_class(w, rare)] -= kept[w]
        words[rare_class(w, rare)] -= 1
    all_tokens, all_words = np.r_[[kept[w] for w in own], tokens].astype(np.int64), np.r_[np.ones(len(own)), words].astype(np.int64)
    order = np.argsort(-all_tokens, kind="stable")
    unit = np.empty(len(order), np.int32)
    unit[order] = np.arange(len(order))
    return Dictionary(kept, rare, unit[: len(own)], unit[len(own) :], all_tokens[order], all_words[order], total, distinct)


def class_bounds(units: int) -> np.ndarray:
    """First units of the classes, and the end. A class is about three times the root of its first unit's rank, which keeps both products small."""
    bounds = [0]
    while bounds[-1] < units:
        bounds.append(min(units, bounds[-1] + math.ceil(3 * math.sqrt(bounds[-1] + 1))))
    return np.array(bounds)


class Bilinear:
    """Parameters: context vectors (one more for before the text), a matrix for each place, vectors and biases of classes and units."""

    def __init__(self, dictionary: Dictionary, size: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        freq = dictionary.tokens.astype(float) + 1
        self.bounds = class_bounds(len(freq))
        c = len(self.bounds) - 1
        self.cls = np.repeat(np.arange(c, dtype=np.int32), np.diff(self.bounds))
        mass = np.add.reduceat(freq, self.bounds[:-1])
        self.class_noise, self.unit_noise = mass / mass.sum(), freq / mass[self.cls]
        self.parts = {
            "context": rng.normal(0, 0.1, (len(freq) + 1, size)).astype(np.float32),
            "near": np.eye(size, dtype=np.float32),
            "far": 0.5 * np.eye(size, dtype=np.float32),
            "class": rng.normal(0, 0.1, (c, size)).astype(np.float32),
            "class_bias": np.log(self.class_noise).astype(np.float32),
            "unit": rng.normal(0, 0.1, (len(freq), size)).astype(np.float32),
            "unit_bias": np.log(self.unit_noise).astype(np.float32),
        }
        self.key = uuid.uuid4().hex

    def copy(self) -> Bilinear:
        mine = Bilinear.__new__(Bilinear)
        mine.__dict__ |= self.__dict__ | {"parts": {n: p.copy() for n, p in self.parts.items()}}
        return mine

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k, p in self.parts.items():
            self.parts[k] = flat[at : at + p.size].reshape(p.shape).astype(np.float32)
            at += p.size
        self.key = uuid.uuid4().hex

    def train(self, target: np.ndarray, near: np.ndarray, far: np.ndarray, rng: np.random.Generator, squares: dict[str, np.ndarray], rate: float) -> None:
        """One pass in steps; squares: sums of squared gradients (AdaGrad) of each part, kept by the caller."""
        P, cls = self.parts, self.cls
        drawn_from, in_class = np.cumsum(self.class_noise), np.cumsum(self.unit_noise)
        class_log, unit_log = np.log(NOISE * self.class_noise).astype(np.float32), np.log(NOISE_UNITS * self.unit_noise).astype(np.float32)
        ends = in_class[self.bounds[1:] - 1]
        begins = np.r_[0, ends[:-1]]

        def move(name: str, gradient: np.ndarray, rows: slice = slice(None)) -> None:
            squares[name][rows] += gradient * gradient
            P[name][rows] += rate * gradient / np.sqrt(squares[name][rows])

        step = min(STEP, max(256, len(target) // 24))  # a small chunk has smaller steps, not fewer
        for i in range(0, len(target), step):
            w, a, b = target[i : i + step], near[i : i + step], far[i : i + step]
            order = np.argsort(cls[w], kind="stable")
            w, a, b = w[order], a[order], b[order]
            va, vb, c, n = P["context"][a], P["context"][b], cls[w], np.float32(1 / len(w))
            hidden = va @ P["near"] + vb @ P["far"]
            noise = np.minimum(np.searchsorted(drawn_from, rng.random(NOISE)), len(drawn_from) - 1)
            gw, gn, gh = contrast(hidden, P["class"], P["class_bias"], c, noise, class_log)
            grad_class, grad_bias = scatter(c, gw[:, None] * hidden, len(drawn_from)), np.bincount(c, gw, len(drawn_from)).astype(np.float32)
            np.add.at(grad_class, noise, gn.T @ hidden)
            np.add.at(grad_bias, noise, gn.sum(axis=0))
            starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            for lo, hi in pairwise([*starts.tolist(), len(c)]):
                k = int(c[lo])
                first, last = int(self.bounds[k]), int(self.bounds[k + 1])
                if last - first < 2:
                    continue
                own, at, h = slice(first, last), w[lo:hi] - first, hidden[lo:hi]
                noise = np.clip(np.searchsorted(in_class, begins[k] + rng.random(NOISE_UNITS) * (ends[k] - begins[k])) - first, 0, last - first - 1)
                uw, un, uh = contrast(h, P["unit"][own], P["unit_bias"][own], at, noise, unit_log[own])
                gh[lo:hi] += uh
                grad, bias = scatter(at, uw[:, None] * h, last - first), np.bincount(at, uw, last - first).astype(np.float32)
                np.add.at(grad, noise, un.T @ h)
                np.add.at(bias, noise, un.sum(axis=0))
                move("unit", grad * n, own)
                move("unit_bias", bias * n, own)
            context = scatter(np.r_[a, b], np.r_[gh @ P["near"].T, gh @ P["far"].T], len(P["context"]))
            for name, gradient in (("near", va.T @ gh), ("far", vb.T @ gh), ("context", context), ("class", grad_class), ("class_bias", grad_bias)):
                move(name, gradient * n)


def contrast(hidden: np.ndarray, vectors: np.ndarray, bias: np.ndarray, target: np.ndarray, noise: np.ndarray, log_noise: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the noise-contrastive objective by the logits of targets and of noise, and by the context vectors."""
    tw, tn, shift = vectors[target], vectors[noise], bias - log_noise
    with np.errstate(over="ignore"):  # an infinite exponential is a gradient of 0
        gw = 1 / (1 + np.exp(np.einsum("ij,ij->i", hidden, tw) + shift[target]))
        gn = -1 / (1 + np.exp(-shift[noise] - hidden @ tn.T))
    return gw, gn, gw[:, None] * tw + gn @ tn


def scatter(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by place."""
    size = rows.shape[1]
    flat = (at[:, None] * size + np.arange(size)).ravel()
    return np.bincount(flat, rows.ravel(), n * size).reshape(n, size).astype(np.float32)


def chunks(texts: Iterator[bytes | None], unit_of: UnitOf, start: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Targets, near and far contexts of whole texts, about CHUNK tokens at a time."""
    parts, n = [], 0
    for text in texts:
        words = (text or b"").lower().split()
        words.append(END)
        ids = np.empty(len(words) + 2, np.int32)
        ids[:2] = start
        ids[2:] = np.fromiter(map(unit_of.__getitem__, words), np.int32, len(words))
        parts.append(ids)
        n += len(words)
        if n >= CHUNK:
            yield joined(parts)
            parts, n = [], 0
    if parts:
        yield joined(parts)


def joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.concatenate([p[2:] for p in parts]), np.concatenate([p[1:-1] for p in parts]), np.concatenate([p[:-2] for p in parts])


def shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[bytes | None]]]:
    """(shard, its texts) from rows shard, text, sorted by shard. A shard's texts must be used up before the next."""
    rows = ((shard, text) for batch in batches for shard, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True))
    head = next(rows, None)

    def texts(shard: int) -> Iterator[bytes | None]:
        nonlocal head
        while head is not None and head[0] == shard:
            yield head[1].as_py()
            head = next(rows, None)

    while head is not None:
        yield head[0], texts(head[0])


def trained(docs: DataFrame, dictionary: Dictionary, size: int = 16, rounds: int = 2, rate: float = 0.1, seed: int = 7) -> Bilinear:
    """docs: doc_id, text of the training documents; all of them are used, in one round each."""
    spark = docs.sparkSession
    model = Bilinear(dictionary, size, seed)
    shared = spark.sparkContext.broadcast(dictionary)
    shards = max(1, math.ceil(dictionary.n_tokens / (rounds * SHARD_TOKENS)))
    content = F.xxhash64("doc_id", "text")
    for k in range(rounds):
        held = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], held=held, k=k) -> Iterator[pa.RecordBatch]:
            d = shared.value
            for shard, texts in shards_of(batches):
                mine, rng, seen = held.value.copy(), np.random.default_rng([seed, k, shard]), 0
                squares = {n: np.full(p.shape, 1e-8, np.float32) for n, p in mine.parts.items()}
                for target, near, far in chunks(texts, unit_of(d), d.units):
                    order = rng.permutation(len(target))
                    mine.train(target[order], near[order], far[order], rng, squares, rate)
                    seen += len(target)
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([float(seen)]), pa.array([(mine.flat() * np.float64(seen)).tobytes()], pa.binary())], names=["slot", "weight", "sums"])

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("slot")  # sums in one order, whatever order the rows come in
            total = sum((np.frombuffer(b) for b in pdf["sums"]), start=np.float64(0))
            return pd.DataFrame({"slot": [pdf["slot"].iloc[0] // FAN_IN], "weight": [pdf["weight"].sum()], "sums": [total.tobytes()]})

        part = docs.filter(fold(F.concat(F.lit("round"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), rounds) == k)
        part = part.select(F.pmod(content, F.lit(shards)).cast("int").alias("shard"), content.alias("content"), "text")
        dealt = part.repartitionById(shards, "shard").sortWithinPartitions("shard", "content").select("shard", "text")
        sums, width = dealt.mapInArrow(run, "slot long, weight double, sums binary"), shards
        while width > 1:  # up a tree: nobody adds up more than a few shards' parameters
            sums = sums.groupBy(F.floor(F.col("slot") / FAN_IN).alias("next")).applyInPandas(add, "slot long, weight double, sums binary")
            width = math.ceil(width / FAN_IN)
        got = sums.collect()
        if got:
            model.load(np.frombuffer(got[0]["sums"]) / got[0]["weight"])
    return model


_unit_of: dict[str, UnitOf] = {}
_scorers: dict[str, tuple[Lookup, Scorer]] = {}


def unit_of(dictionary: Dictionary) -> UnitOf:
    if dictionary.key not in _unit_of:
        _unit_of.clear()
        _unit_of[dictionary.key] = UnitOf(dictionary)
    return _unit_of[dictionary.key]


class Scorer:
    """Normalised log probabilities of units."""

    def __init__(self, model: Bilinear) -> None:
        P, self.bounds, self.cls = model.parts, model.bounds, model.cls
        one = lambda v: np.c_[v, np.full(len(v), 0.5, np.float32)]  # noqa: E731  # two halves make the one that the bias is multiplied by
        self.near, self.far = one(P["context"] @ P["near"]), one(P["context"] @ P["far"])
        self.classes = np.ascontiguousarray(np.c_[P["class"], P["class_bias"]].T)
        units = np.c_[P["unit"], P["unit_bias"]]
        self.units = [np.ascontiguousarray(units[a:b].T) for a, b in pairwise(self.bounds)]
        norm = lambda v, axis: float(np.sqrt((v * v).sum(axis=axis)).max())
        self.small = (norm(self.near, 1) + norm(self.far, 1)) * max(norm(w, 0) for w in (self.classes, *self.units)) < 80  # no logit leaves the range of exponentials

    def choice(self, hidden: np.ndarray, weights: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log probability of each target among the columns of weights."""
        out, step = np.empty(len(target)), max(64, LOGITS // weights.shape[1])
        for i in range(0, len(target), step):
            logits = hidden[i : i + step] @ weights
            own = logits[np.arange(len(logits)), target[i : i + step]]
            if not self.small:
                top = logits.max(axis=1)
                logits -= top[:, None]
                own -= top
            out[i : i + step] = own - np.log(np.exp(logits, out=logits).sum(axis=1))
        return out

    def logs(self, target: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Natural log probability of each unit in its context."""
        if len(target) > SCORED:
            return np.concatenate([self.logs(target[i : i + SCORED], near[i : i + SCORED], far[i : i + SCORED]) for i in range(0, len(target), SCORED)])
        c = self.cls[target]
        order = np.argsort(c, kind="stable")
        target, c, out = target[order], c[order], np.empty(len(target))
        hidden = self.near[near[order]]
        hidden += self.far[far[order]]
        logs = self.choice(hidden, self.classes, c)
        starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]]).tolist()
        for lo, hi in pairwise([*starts, len(c)]):
            k = int(c[lo])
            if self.units[k].shape[1] > 1:
                logs[lo:hi] += self.choice(hidden[lo:hi], self.units[k], target[lo:hi] - self.bounds[k])
        out[order] = logs
        return out


class Lookup:
    """The dictionary as arrays by place; the last place stands for all other words."""

    def __init__(self, d: Dictionary) -> None:
        self.place, top = {w: i for i, w in enumerate(d.counts)}, len(d.top_units)
        self.unit = np.r_[d.index(), 0].astype(np.int32)
        self.base = np.r_[np.log10(np.fromiter(d.counts.values(), float, len(d.counts)) + 1), 0]
        self.within = np.where(np.arange(len(self.unit)) < top, 0, self.base)
        self.one_in_unit = np.zeros(d.units)
        self.one_in_unit[d.rare_units] = -np.log10(d.tokens[d.rare_units] + d.words[d.rare_units] + 1.0)
        self.one = -np.log10(d.n_tokens + d.n_words + 1)


def tools(d: Dictionary, model: Bilinear) -> tuple[Lookup, Scorer]:
    """Made once for each worker and model."""
    key = f"{d.key} {model.key}"
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Lookup(d), Scorer(model)
    return _scorers[key]


def document_parts(docs: DataFrame, dictionary: Dictionary, model: Bilinear) -> DataFrame:
    """docs: row, doc_id, text. Scores without the words beyond the dictionary; those are listed with their number."""
    spark = docs.sparkSession
    shared, held = spark.sparkContext.broadcast(dictionary), spark.sparkContext.broadcast(model)
    types = {"row": pa.int64(), "doc_id": pa.int64(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64(), "words": pa.list_(pa.binary()), "times": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = shared.value
        look, scorer = tools(d, held.value)
        last, rare_units = len(d.counts), d.rare_units.tolist()
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                places, contexts, rests = [], [], []
                for text in part.column(2).cast(pa.large_binary()):
                    words = (text.as_py() or b"").lower().split()
                    words.append(END)
                    at = np.fromiter(map(look.place.get, words, repeat(last)), np.int32, len(words))
                    units = look.unit[at]
                    other = np.flatnonzero(at == last).tolist()
                    units[other] = [rare_units[zlib.crc32(words[j][-2:]) % d.rare] for j in other]
                    rests.append(Counter([words[j] for j in other]))
                    places.append(at)
                    contexts.append(np.r_[d.units, d.units, units].astype(np.int32))
                starts = np.cumsum([0, *map(len, places)])[:-1]
                at, (target, near, far) = np.concatenate(places), joined(contexts)
                score = scorer.logs(target, near, far) / LOG10 + look.one_in_unit[target] + look.within[at]
                n = np.array([len(p) for p in places])
                cols = [
                    part.column(0), part.column(1), n, np.add.reduceat((at != last).astype(np.int64), starts), np.add.reduceat(look.base[at], starts) + n * look.one,
                    np.add.reduceat(score, starts), [list(r) for r in rests], [list(r.values()) for r in rests],
                ]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, types.values(), strict=True)], names=list(types))

    schema = "row long, doc_id long, n_tokens long, n_known long, base_score double, score double, words array<binary>, times array<long>"
    return docs.select("row", "doc_id", "text").mapInArrow(run, schema)


def lm_scores(docs: DataFrame, modulus: int = 7, held: int = 2, top: int | None = None, rare: int | None = None, dictionary: int = 131_072, size: int = 16) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    top, rare: words and groups with vectors of their own, None for as many as the corpus asks for. The texts are read once for
    the counts, once for training and once for scoring. A frequent word is in
    the dictionary, so the join with the other counts has no hot key: none of its words makes up
    more than 1 / dictionary of all tokens.
    """
    outside = docs.filter(fold(F.col("doc_id"), modulus) != held).select("doc_id", "text")
    counts = written(word_counts(outside, end=END).select("word", "n"), "lm-counts")
    words = dictionary_of(counts, top, rare, dictionary)
    model = trained(outside, words, size)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    parts = written(document_parts(numbered, words, model), "lm-parts")
    rest = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("e")).select("row", F.col("e.words").alias("word"), "e.times")
    found = rest.join(counts, "word").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("more_known"))
    more, known = F.coalesce("more", F.lit(0.0)), F.coalesce("more_known", F.lit(0))
    return parts.drop("words", "times").join(found, "row", "left").select(
        "doc_id", (fold(F.col("doc_id"), modulus) == held).alias("held_out"), "n_tokens", (F.col("n_known") + known).alias("n_known"),
        F.lit(words.n_tokens).cast("long").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )
