"""Quality rules whose cutoffs carry a proven bound on false rejections.

Each rule is a measure of the text and a direction. Documents with a quality label are the holdout: the
measures are not learned, so none of them has been used before. In every stratum the rules
are taken one after another, and each rule's cutoffs from mild to strict: of the good documents (quality 1)
that pass the base rules, how many would be rejected by this cutoff or by the rules settled before, and what
is the exact (Clopper-Pearson) upper bound on that share. Of the cutoffs up to which all bounds stay under `risk`
the mildest is taken that catches the most bad documents (quality 0) not caught before; if none catches any, or
the mildest fails, the rule has no cutoff: clean documents are not given up for nothing.

What is tested at a rule depends on the cutoffs chosen before it from the same labels, so the level of each bound is delta divided by
the number of strata and of all combinations of cutoffs that the ladders allow (Bonferroni over every set that could have been
tested; the bounds move little, as they grow with the logarithm). So with probability 1 - delta no stratum loses more
than `risk` of its good documents to all rules together, whatever combination is chosen. Choosing needs a row for each stratum and is done
in tasks.

Defined cases: a null text has no words and fails the base rules. A null stratum is a stratum. A stratum
without good labelled documents has no cutoffs and keeps all that pass the base rules. Repeated labels of
a document count once (its largest quality label); labels without a document count nothing. Ties with a
cutoff are kept. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import written

SYMBOLS = b"#*$%&|<>"
#: Strata whose cutoffs may be broadcast (a name and a number for each rule); beyond it the join shuffles.
BROADCAST_STRATA = 10_000
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Rule: SQL of a measure of which larger is worse, and its ladder from mild to strict.
RULES = {
    "symbols_a_word": ("n_symbols / greatest(n_words, 1)", [2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02]),
    "repeated_share": ("n_repeat_words / greatest(n_words, 1)", [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1]),
    "dup_lines_a_100_words": ("100 * n_dup_lines / greatest(n_words, 1)", [8.0, 4.0, 2.0, 1.0, 0.5, 0.25]),
    "long_words": ("word_chars / greatest(n_words, 1)", [20.0, 15.0, 12.0, 10.0, 9.0, 8.0]),
    "short_words": ("- word_chars / greatest(n_words, 1)", [-1.5, -2.0, -2.5, -3.0, -3.5]),
}


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that are found twice or more, the first included."""
    n = len(words) - 2
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pairs = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)[1]
    _, at, times = np.unique(pairs[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True)
    again = times[at] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k : n + k] |= again
    return int(hit.sum())


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def measured(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and the measures of the whole text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py() or b"") for t in batch.column(2).cast(pa.large_binary())]
            cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["doc_id", "stratum", *MEASURES])

    light = docs.select(F.col("doc_id").cast("long"), F.col(stratum).cast("string").alias("stratum"), "text")
    return light.mapInArrow(run, "doc_id long, stratum string, " + ", ".join(f"{m} long" for m in MEASURES))


def upper_bound(k: int, n: int, delta: float) -> float:
    """Exact upper bound for a share at level delta, k of n seen: the p with P(X <= k | n, p) = delta."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    choose = math.lgamma(n + 1) - np.array([math.lgamma(j + 1) + math.lgamma(n - j + 1) for j in i])
    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        logs = choose + i * math.log(p) + (n - i) * math.log1p(-p) if 0 < p < 1 else np.array([-math.inf])
        low, high = (p, high) if np.exp(logs).sum() > delta else (low, p)
    return high


def chosen_cutoff(rejected: list[int], caught: list[int], good: int, ladder: list[float], risk: float, level: float) -> float | None:
    """Of the cutoffs before the first whose bound is over the risk, the first that catches the most; None if that is nothing."""
    best, most = None, 0
    for k, n, cutoff in zip(rejected, caught, ladder, strict=True):
        if not good or upper_bound(int(k), int(good), level) > risk:
            break
        if n > most:
            best, most = cutoff, n
    return best


def base_failed(min_words: int = 50):
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def combinations() -> int:
    """Sets of cutoffs that can be chosen: for each rule one of its ladder or none."""
    return math.prod(len(ladder) + 1 for _, ladder in RULES.values())


def picked(counts: DataFrame, ladder: list[float], risk: float, level: float) -> DataFrame:
    """counts: stratum, good, k0.., b0..: rejected good and caught bad documents for each cutoff. stratum, cutoff of the strata that get one."""
    n = len(ladder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            found = [(r[0], cut) for r in rows if (cut := chosen_cutoff(list(r[2 : 2 + n]), list(r[2 + n :]), r[1], ladder, risk, level)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.string()), pa.array([c for _, c in found], pa.float64())], names=["stratum", "cutoff"])

    return counts.mapInArrow(run, "stratum string, cutoff double")


def cutoffs(measures: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """stratum, rule, cutoff. All labelled documents count, through an aggregation for each rule to a row for each stratum."""
    quality = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality")).filter("quality IS NOT NULL")
    held = measures.filter(~base_failed()).join(quality, "doc_id").withColumn("good", F.col("quality") == 1)
    held = written(held.withColumn("gone", F.lit(False)), "quality-holdout")
    level, chosen = delta / max(1, held.select("stratum").distinct().count() * combinations()), []
    for rule, (sql, ladder) in RULES.items():
        over = [F.expr(sql) > F.lit(cut) for cut in ladder]
        rejected = [F.count_if(F.col("good") & (F.col("gone") | x)).alias(f"k{i}") for i, x in enumerate(over)]
        caught = [F.count_if(~F.col("good") & ~F.col("gone") & x).alias(f"b{i}") for i, x in enumerate(over)]
        counts = held.groupBy("stratum").agg(F.count_if("good").alias("good"), *rejected, *caught)
        new = written(picked(counts, ladder, risk, level).select("stratum", F.lit(rule).alias("rule"), "cutoff"), "quality-cutoffs")
        chosen.append(new)
        n = new.count()
        if n:
            side = new.select(F.col("stratum").alias("_s"), F.col("cutoff").alias("_cut"))
            side = F.broadcast(side) if n <= BROADCAST_STRATA else side
            held = held.join(side, F.col("stratum").eqNullSafe(F.col("_s")), "left").withColumn("gone", F.col("gone") | F.coalesce(F.expr(sql) > F.col("_cut"), F.lit(False))).drop("_s", "_cut")
    return reduce(DataFrame.unionByName, chosen)


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """doc_id, the measures, base_failed, kept and rejected_by (names of rules, sorted)."""
    measures = written(measured(docs, stratum), "quality-measures")
    limits = cutoffs(measures, labels, risk, delta).groupBy(F.col("stratum").alias("_s")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    limits = written(limits, "quality-limits")
    side = F.broadcast(limits) if limits.count() <= BROADCAST_STRATA else limits
    rows = measures.join(side, F.col("stratum").eqNullSafe(F.col("_s")), "left")
    broken = [F.when(F.expr(sql) > F.try_element_at("limits", F.lit(rule)), F.lit(rule)) for rule, (sql, _) in RULES.items()]
    rows = rows.select("doc_id", *MEASURES, base_failed().alias("base_failed"), F.array_sort(F.array_compact(F.array(*broken))).alias("rejected_by"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
