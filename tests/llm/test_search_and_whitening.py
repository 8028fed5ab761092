"""Vector search, lexical search and whitening against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tallymart.llm import lexical_search, top_lists, vector_search, vectors, whitening

VECTORS = "vec_id long, embedding array<double>, label string, vec string, id int, top string"


def table(spark, rows):
    """Extra columns carry names that the operators use themselves."""
    return spark.createDataFrame([(i, v, "l", "v", 1, "t") for i, v in rows], VECTORS)


def takes_part(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def clipped(n):
    return max(-(2**63 - 1), min(2**63 - 1, n))


def plain_search(rows, every, k):
    whole = lambda x: int(max(-vectors.LARGEST, min(vectors.LARGEST, math.floor(1024 * x) if abs(x) < 1e300 else math.copysign(vectors.LARGEST, x))))
    rows = [(i, [whole(x) for x in v]) for i, v in rows if takes_part(v)]
    out = []
    for n, (q, v) in enumerate(rows):
        if q is not None and q % every == 0:
            found = sorted((-clipped(sum(a * b for a, b in zip(v, w, strict=False))), i is None, i or 0) for m, (i, w) in enumerate(rows) if m != n)
            out += [(q, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(found[:k], 1)]
    return Counter(out)


def searched(spark, rows, every=3, k=4, cut=5):
    return Counter(tuple(r) for r in vector_search.nearest(table(spark, rows).repartition(cut), every, k).collect())


def test_vector_search_is_brute_force(spark, monkeypatch):
    draw = random.Random(3)
    some = [(i, [draw.uniform(-1, 1) for _ in range(6)]) for i in range(90)]
    odd = [(3, None), (6, [1.0, None]), (9, [float("nan")] * 6), (12, [float("inf")] + [0.0] * 5), (15, []), (18, [2.0]), (None, [1.0] * 6), (None, [1.0] * 6), (21, [0.5] * 9), (-3, [1.0] * 6)]
    hot = [(200 + i, [0.25] * 6) for i in range(60)] + [(300, [0.25] * 6)] * 3 + [some[0]] * 2
    rows = some + odd + hot
    for most in (vector_search.ROWS, 7):
        monkeypatch.setattr(vector_search, "ROWS", most)
        assert searched(spark, rows) == plain_search(rows, 3, 4)


def test_vector_search_large_numbers_and_small_tables(spark):
    rows = [(i, [(-1) ** i * 10.0 ** (9 + i), 3e6 * i]) for i in range(8)] + [(30, [1e303, 1e303]), (33, [-1e303, -1e303])]
    assert searched(spark, rows) == plain_search(rows, 3, 4)
    assert searched(spark, [(3, [1.0])]) == Counter()
    assert searched(spark, [(3, [1.0]), (4, [2.0])]) == Counter([(3, 1, 4, 2 * 1024 * 1024)])
    assert searched(spark, []) == searched(spark, [(3, None)]) == Counter()


@given(st.lists(st.lists(st.integers(-2, 2), min_size=5, max_size=5), min_size=1, max_size=6), st.integers(1, 7))
@settings(deadline=None, max_examples=60)
def test_selected_takes_the_first_of_equal_scores(scores, k):
    got = top_lists.selected(np.array(scores), k).tolist()
    assert got == [sorted(range(5), key=lambda c: (-row[c], c))[:k] for row in scores]


def test_lists_merge_up_a_tree(spark):
    rows = [(k, n, [(-(n * 7 % 11), False, n)]) for k in (1, 2) for n in range(300)]
    tops = spark.createDataFrame(rows, f"key int, node long, top {top_lists.TOP}").repartition(7)
    want = [x[2][0] for x in sorted(rows[:300], key=lambda x: x[2][0])[:5]]
    assert [(r.key, [tuple(e) for e in r.top]) for r in top_lists.merged(tops, ["key"], 300, 5).orderBy("key").collect()] == [(1, want), (2, want)]


# Lexical search.

DOCS = "doc_id long, text string, n long, terms string, top string, node int"
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_ranks(docs, items, k):
    terms = lambda t: PATTERN.findall((t or "").translate(LOWER))
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n, length = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, size in held:
            m = 100 - 75 + (75 * size * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def lexical(spark, docs, items, k=5, cut=4):
    d = spark.createDataFrame([(i, t, 1, "t", "x", 2) for i, t in docs], DOCS).repartition(cut)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, no int")
    return Counter(tuple(r) for r in lexical_search.ranked(d, q, k).collect())


def test_lexical_search_is_brute_force(spark, monkeypatch):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "über", "naïve", "Ñ", "ÉTÉ", "x9", "THE", "the"]
    text = lambda n: draw.choice([" ", "-", "\n", "_"]).join(draw.choice(words) for _ in range(n))
    docs = [(i, text(draw.randint(1, 60))) for i in range(150)]
    docs += [(500 + i, docs[7][1]) for i in range(70)] + [docs[3]] * 3 + [(None, docs[7][1]), (None, docs[8][1]), (900, None), (901, ""), (902, " -\t\x00 "), (-4, "w1")]
    docs.append((903, "w1 w2 " * 400_000 + "Ünder"))
    items = [(i, text(draw.randint(1, 25))) for i in range(30)] + [(40, None), (41, ""), (42, "nothing of it"), (None, "w1 W2 über"), (0, "w5"), (0, "w5"), (43, "w7 " * 200)]
    want = plain_ranks(docs, items, 5)
    assert lexical(spark, docs, items) == want
    monkeypatch.setattr(lexical_search, "BATCH", 9)
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 900)
    assert lexical(spark, docs, items) == want


def test_lexical_search_without_rows(spark):
    assert lexical(spark, [], [(1, "a")]) == lexical(spark, [(1, "a b")], []) == lexical(spark, [(1, None)], [(1, "a")]) == lexical(spark, [(1, "a")], [(1, None)]) == Counter()


def search_of(texts, items, repeat=1):
    """A Search that has seen the texts."""
    numbers, found = {}, []
    for no, text in enumerate(items):
        c = Counter(text.split())
        found.append((no, np.array([numbers.setdefault(t, len(numbers)) for t in c]), np.array(list(c.values()))))
    counts = [Counter(numbers[t] for t in text.split() if t in numbers) for text in texts]
    w = np.full(len(numbers), 1000)
    search = lexical_search.Search(lexical_search.batched(found, w), len(texts), sum(len(t.split()) for t in texts), 3)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array([len(t.split()) for t in texts], pa.int64()), pa.array([sorted(c) for c in counts], pa.list_(pa.int32())), pa.array([[c[k] for k in sorted(c)] for c in counts], pa.list_(pa.int32()))],
        names=["doc_id", "n", "terms", "tfs"],
    )
    for at in range(0, len(texts), 500):
        search.documents(batch.slice(at, 500))
    return search


def test_bounds_prune_pairs_of_other_topics():
    draw = random.Random(1)
    topic = lambda k, n: " ".join(f"t{k}_{draw.randint(0, 30)}" for _ in range(n))
    search = search_of([topic(i % 20, 40) for i in range(4000)], [topic(i % 20, 20) for i in range(40)])
    assert search.scored < 0.1 * search.pairs and all(len(x[0]) == 3 for x in search.best.of.values())


def test_items_of_large_sums_are_searched_in_whole_numbers():
    many = " ".join(["w1"] * 9_000_000)
    search = search_of(["w1 w1 x", "w1", "x"], [many])
    assert search.batches[0].root.coefficients.dtype == np.int64
    m = [25 + 75 * n * 3 // 5 for n in (3, 1)]
    assert search.best.of[0][0].tolist() == sorted((9_000_000 * 1000 * (1_000_000_000 * tf // (1000 * tf + 8 * x)) for tf, x in zip((2, 1), m, strict=True)), reverse=True)


# Whitening.


def plain_whitening(rows, k=4):
    rows = [(i, v) for i, v in rows if takes_part(v)]
    width = max(len(v) for _, v in rows)
    x = [[math.floor(256 * c) for c in v] + [0] * (width - len(v)) for _, v in rows]
    fit = [list(v) for v in {tuple(v) for v in x}]
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    c = np.array([[(n * a - b) / n for a, b in zip(v, s, strict=True)] for v in fit])
    e, u = np.linalg.eigh(c.T @ c / n)
    w = np.array([[(n * a - b) / n for a, b in zip(v, s, strict=True)] for v in x]) @ u[:, ::-1][:, :k] / np.sqrt(e[::-1][:k])
    return [i for i, _ in rows], n, [sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True)) for v in x], w, e[::-1] / e.sum()


def test_whitening_is_the_eigendecomposition(spark):
    draw = random.Random(8)
    some = [(i, [3 * draw.gauss(0, 1), draw.gauss(5, 1), 0.4 * draw.gauss(0, 1) + 1000, draw.gauss(0, 0.2), 0.1 * draw.gauss(0, 1), 7.0]) for i in range(300)]
    rows = some + [(900 + i, [0.5] * 6) for i in range(150)] + [some[4]] * 2 + [(None, [1.0, 2.0]), (950, None), (951, [1.0, None]), (952, [float("nan")] * 6), (953, [float("-inf")] * 6), (954, [])]
    got = whitening.whitened(table(spark, rows).repartition(5)).toPandas()
    ids, n, deviation, w, explained = plain_whitening(rows)
    assert len(got) == 4 * len(ids) and set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10
    for k in range(4):
        g = got[got.component == k + 1]
        assert g.explained.iloc[0] == pytest.approx(explained[k], rel=1e-9) and g.explained.nunique() == 1
        mine = sorted(zip(g.vec_id.fillna(-1), g.deviation, g.whitened, strict=True))
        sign = np.sign(np.dot(g[g.vec_id == 0].whitened, w[0, k]))
        theirs = sorted(zip([-1 if i is None else i for i in ids], deviation, sign * w[:, k], strict=True))
        assert [x[:2] for x in mine] == [x[:2] for x in theirs] and np.allclose([x[2] for x in mine], [x[2] for x in theirs], atol=1e-8)


def test_whitening_has_as_many_components_as_rank(spark):
    on_a_line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]
    got = whitening.whitened(table(spark, on_a_line)).toPandas()
    assert set(got.component) == {1} and got.explained.iloc[0] == pytest.approx(1) and got.identity_error.iloc[0] < 1e-12
    for rows in ([], [(1, None)], [(1, [])], [(1, [2.0, 3.0])], [(1, [2.0]), (2, [2.0])]):
        assert whitening.whitened(table(spark, rows)).count() == 0


def test_whitening_of_large_entries_is_exact(spark):
    rows = [(i, [1e13 + i, -(2.0**40) * i, 1e-2 * i * i]) for i in range(12)]
    got = whitening.whitened(table(spark, rows), components=2).toPandas()
    _, n, deviation, w, explained = plain_whitening(rows, 2)
    assert got.identity_error.iloc[0] < 1e-9 and got[got.component == 1].explained.iloc[0] == pytest.approx(explained[0], rel=1e-9)
    assert [None if math.isnan(d) else int(d) for d in got[got.component == 1].sort_values("vec_id").deviation] == [d if d < 2**63 else None for d in deviation]


def test_factor_and_rotations_keep_small_eigenvalues():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(7, 7)))
    e = np.array([1e6, 10.0, 10.0, 1e-2, 1e-5, 1e-6, 0.0])
    v = (q * e) @ q.T
    a = whitening.pivoted_cholesky((v + v.T) / 2)
    assert np.allclose(a @ a.T, v, atol=1e-8)
    squared, unit = whitening.jacobi(a)
    assert np.allclose(squared[:5], e[:5], rtol=1e-3) and np.allclose(unit.T @ unit, np.eye(unit.shape[1]), atol=1e-9)


@given(st.lists(st.lists(st.integers(-(2**62), 2**62) | st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=8))
@settings(deadline=None, max_examples=60)
def test_narrow_forms_and_limbs_come_back(rows):
    x = np.array(rows, np.int64)
    assert (whitening.widened(pa.array(whitening.narrowed(x), pa.binary()), 3) == x).all()
    assert (sum(y.astype(np.int64).astype(object) << (whitening.LIMB * k) for k, y in enumerate(whitening.limbs(x))) == x).all()
