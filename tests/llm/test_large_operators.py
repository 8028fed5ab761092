"""Line and near deduplication, packing, language identification, scoring and the pipeline against plain versions."""

import random
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallymart.llm import components, language_id, line_dedup, lm_score, near_dedup, packing

DOCS = "doc_id long, text string, lang string, source string, n_chars int, node string, item long, seq long"


def docs_of(spark, texts, langs=None):
    return spark.createDataFrame([(i, t, (langs or {}).get(i, "en"), "s", len(t or ""), "x", 1, 2) for i, t in texts], DOCS)


def path(name):
    import public_tokenizers

    return str(public_tokenizers.path(name))


# Line deduplication.


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutated(rng, s, k):
    s = list(s)
    for _ in range(k):
        i, way = rng.randrange(len(s)), rng.random()
        if way < 0.34:
            s.insert(i, rng.choice("abé"))
        elif way < 0.67:
            s.pop(i)
        else:
            s[i] = rng.choice("abé")
    return "".join(s)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_bit_parallel_distance(spark, edits):
    rng, rows = random.Random(edits), []
    while len(rows) < 400:
        a = "".join(rng.choice("ab") for _ in range(rng.randint(6, 24)))
        b = mutated(rng, a, rng.randint(0, edits + 2)).replace("é", "c")
        if abs(len(a) - len(b)) <= edits:
            rows.append((a, b, distance(a, b) <= edits))
    df = spark.createDataFrame(rows, "a string, b string, want boolean").withColumn("got", line_dedup.within(F.col("a"), F.col("b"), edits))
    assert df.filter("got <> want").count() == 0


def test_common_ends_go(spark):
    pairs = [("abcdef", "abXdef", "c", "X"), ("aaa", "aaaa", "", "a"), ("abab", "ab", "ab", ""), ("x", "y", "x", "y"), ("same", "same", "", ""), ("é1" * 40, "é1" * 19 + "é" + "é1" * 20, "1", "")]
    df = spark.createDataFrame(pairs, "x string, y string, wx string, wy string")
    assert all((r.x, r.y) == (r.wx, r.wy) for r in line_dedup.stripped(df, 100).collect())


def test_lines_of_a_template(spark, monkeypatch):
    """Numbered lines of templates whose rests are cut again, short and long ones, joined without a broadcast."""
    monkeypatch.setattr(line_dedup, "CROWD", 16)
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    rng = random.Random(9)
    texts = [(i, f"this is a line of the template, number {rng.randrange(10**6):06d}, and it ends here\nand {rng.randrange(100)} is a line that comes back") for i in range(120)]
    texts += [(200 + i, f"{rng.choice('ab')} {rng.randrange(30):02d} and a middle part that all of them have in common {rng.randrange(30)} {rng.choice('xy')}") for i in range(60)]
    want = brute_lines(texts, 20, 2)
    report = {r.doc_id: r.removed for r in line_dedup.line_report(docs_of(spark, texts).repartition(4)).collect()}
    assert {i: r for i, r in report.items() if r} == {i: ",".join(map(str, v)) for i, v in want.items()}


@pytest.mark.parametrize(("edits", "short"), [(2, 5), (1, 3)])
def test_pairs_of_a_template_are_all_links(spark, monkeypatch, edits, short):
    """No link between lines of a template is lost, however short a rest is that is no longer cut."""
    monkeypatch.setattr(line_dedup, "CROWD", 16)
    monkeypatch.setattr(line_dedup, "SHORT", short)
    rng = random.Random(edits + short)
    lines = list({mutated(rng, f"the number {rng.randrange(200)} of a list, {rng.choice(['red', 'green'])} as ever", rng.choice([0, 0, 1])).encode().decode("latin-1") for _ in range(150)})
    df = spark.createDataFrame(list(enumerate(lines)), "h1 long, b string").withColumn("n", F.length("b"))
    found = {(r.x, r.y) for r in line_dedup.candidate_pairs(df, edits).collect()}
    links = {(i, k) for i in range(len(lines)) for k in range(i + 1, len(lines)) if distance(lines[i], lines[k]) <= edits}
    assert links <= found and all(x < y for x, y in found)


def test_near_copies_of_a_line_meet_in_few_rests(spark, monkeypatch):
    """Long lines that differ in a few words and so in length: no link is lost, and a round does not multiply their rests."""
    rests, real = [], line_dedup.written

    def spied(df, label, rows=None):
        out = real(df, label, rows)
        rests.extend([out.count()] if label == "line-rests" else [])
        return out

    monkeypatch.setattr(line_dedup, "CROWD", 16)
    monkeypatch.setattr(line_dedup, "written", spied)
    rng, words, lines = random.Random(11), [f"word{i * 7919 % 1000:03d}" for i in range(40)], set()
    while len(lines) < 150:
        copy = list(words)
        for _ in range(rng.choice([0, 1, 1, 2])):
            copy[rng.randrange(40)] = "x" * rng.randrange(5, 10)
        lines.add(mutated(rng, " ".join(copy), rng.choice([0, 1, 1, 2])).encode().decode("latin-1"))
    lines = sorted(lines)
    df = spark.createDataFrame(list(enumerate(lines)), "h1 long, b string").withColumn("n", F.length("b"))
    found = {(r.x, r.y) for r in line_dedup.candidate_pairs(df, 2).collect()}

    def near(a, b, edits):
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905
        a, b = a[n:], b[n:]
        return len(a) + len(b) <= edits if not (a and b) else edits > 0 and any(near(x, y, edits - 1) for x, y in ((a[1:], b), (a, b[1:]), (a[1:], b[1:])))

    links = {(i, k) for i in range(len(lines)) for k in range(i + 1, len(lines)) if near(lines[i], lines[k], 2)}
    assert links and links <= found
    assert sum(rests) < 20 * len(lines)


def test_short_rests_meet_if_and_only_if_they_are_near(spark):
    rng = random.Random(3)
    rests = sorted({"".join(rng.choice("012") for _ in range(rng.randint(0, 6))) for _ in range(120)})
    df = spark.createDataFrame([(1, i, b) for i, b in enumerate(rests)], "key long, id long, b string")
    for edits in (1, 2):
        got = Counter((r.x, r.y) for r in line_dedup.short_pairs(df, edits).collect())
        assert got == Counter((i, k) for i in range(len(rests)) for k in range(i + 1, len(rests)) if distance(rests[i], rests[k]) <= edits)


def test_rests_of_a_key_lose_what_all_have(spark):
    rows = [(1, 1, "abc1de"), (1, 2, "abc22de"), (1, 3, "abde"), (2, 4, "same"), (2, 5, "same"), (3, 1, "c1"), (3, 2, "c22"), (3, 3, "")]
    df = line_dedup.without_ends(spark.createDataFrame(rows, "key long, id long, b string"))
    assert {(r.key, r.id): r.b for r in df.collect()} == {(1, 1): "c1", (1, 2): "c22", (1, 3): "", (2, 4): "", (2, 5): "", (3, 1): "c1", (3, 2): "c22", (3, 3): ""}
    assert {r.key for r in line_dedup.without_copies(df).collect()} == {1, 2}


def test_parities_share_a_part(spark):
    rng, rows = random.Random(11), []
    for _ in range(300):
        a = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(2, 60)))
        rows.append((a, mutated(rng, a, rng.randint(0, 2)).replace("é", "z") or "z"))
    df = spark.createDataFrame(rows, "a string, b string").select(*[line_dedup.bigram_parities(F.col(c), 2).alias(c) for c in "ab"])
    for r in df.filter("size(a) = 9").collect():
        assert len(r.a) == len(r.b) == 9 and any(x == y for x, y in zip(r.a, r.b, strict=True)) and sum((x ^ y).bit_count() if x ^ y >= 0 else ((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(r.a, r.b, strict=True)) <= 8


def brute_lines(texts, least, edits):
    """Removed positions by document."""
    places = [(i, k, x.encode()) for i, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)) for k, x in enumerate((t or "").split("\n")) if t is not None and len(x.encode()) >= least]
    seen, gone = set(), defaultdict(list)
    for i, k, x in places:
        near = x not in seen and any(abs(len(x) - len(y)) <= edits and distance(x, y) <= edits for y in seen)
        if x in seen or near:
            gone[i].append(k)
        seen.add(x)
    return {i: sorted(v) for i, v in gone.items()}


def test_lines_against_brute_force(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcé ") for _ in range(rng.randint(18, 60))) for _ in range(25)]
    texts = []
    for i in range(60):
        lines = [mutated(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3, 6])) for _ in range(rng.randint(1, 6))] + ["short", "short"]
        texts.append((i, "\n".join(lines)))
    texts += [(100, None), (101, ""), (102, "\n\n"), (None, base[0]), (103, "x" * 700 + base[1]), (104, "x" * 700 + base[1] + "y")]
    df = docs_of(spark, texts).repartition(5)
    want = brute_lines(texts, 20, 2)
    report = {r.doc_id: r for r in line_dedup.line_report(df, least=20, edits=2).collect()}
    assert len(report) == len(texts)
    assert {i: r.removed for i, r in report.items() if r.removed} == {i: ",".join(map(str, v)) for i, v in want.items()}
    kept = {r.doc_id: r.text for r in line_dedup.deduplicated(df, least=20, edits=2).collect()}
    for i, t in texts:
        left = None if t is None else [x for k, x in enumerate(t.split("\n")) if k not in want.get(i, ())]
        assert (i not in kept) if left == [] else kept[i] == (t if left is None else "\n".join(left))
    assert report[100].n_lines == 0 and report[101].n_lines == 1 and report[104].removed == "0"
    assert line_dedup.line_report(df.limit(0)).count() == 0 and line_dedup.deduplicated(df).columns == df.columns


def test_lines_leave_the_disk_before_more_is_shuffled(spark, monkeypatch):
    from tallymart.tables import shared_folder

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        sizes = []
        while files.hasNext():
            sizes.append(files.next().length())
        return sum(sizes)

    def least(below):
        """Bytes of shuffle files, once they are few or 5 seconds have gone."""
        for _ in range(25):
            if (n := shuffled()) < below:
                break
            time.sleep(0.2)
        return n

    def spied(df, label, *more, **options):
        if label in ("line-crowded-ids", "line-pairs"):
            kept[label] = least(size // 3)
        if label.startswith("line-crowded"):
            lines = plan(df).splitlines()
            by_key.extend(below for at, below in zip(lines, lines[1:], strict=False) if re.search(r"Exchange hashpartitioning\(key#\d+L?, \d+\)", at))
        return real(df, label, *more, **options)

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    rng, real, kept, by_key = random.Random(7), line_dedup.written, {}, []
    lines = ["".join(rng.choices("0123456789abcdefghijklmnopqrstuvwxyz ", k=5_000)) for _ in range(300)]
    lines += [lines[0][:at] + "#" + lines[0][at + 1 :] for at in (700, 2_000, 3_000, 4_700)]
    size = sum(map(len, lines))
    df = docs_of(spark, enumerate(lines)).repartition(4)
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    monkeypatch.setattr(line_dedup, "written", spied)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = line_dedup.deduplicated(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = sum(f.stat().st_size for p in folder.iterdir() if p.name not in before for f in p.rglob("*.parquet"))
    assert len(kept) == 2 and max(kept.values()) < size // 3
    assert by_key and not any(" b#" in below for below in by_key)
    assert left < size // 10
    assert sorted(r.doc_id for r in got.collect()) == list(range(300))


def test_lines_of_rows_without_an_identifier_of_their_own(spark):
    """Null and repeated identifiers: only lines that stand elsewhere go, and of equal rows one keeps its lines."""
    once = [f"line number {k:03d} {chr(97 + k) * 12}" for k in range(12)]
    again = "this line is in several of the documents"
    texts = [(None, f"{again}\n{once[0]}"), (None, f"{once[1]}\n{again}"), (None, f"{once[2]}\n{once[3]}"), (5, f"{again}\n{once[4]}"), (5, f"{once[5]}\n{again}"), (9, once[6]), (9, once[6]), (None, once[7]), (None, once[7]), (10, once[8])]
    df = docs_of(spark, texts).repartition(3)
    kept = Counter((r.doc_id, x) for r in line_dedup.deduplicated(df).collect() for x in r.text.split("\n"))
    want = [(None, x) for x in (again, *once[:4], once[7])] + [(5, once[4]), (5, once[5]), (9, once[6]), (10, once[8])]
    assert kept == Counter(want)
    report = line_dedup.line_report(df).collect()
    assert Counter(r.doc_id for r in report) == Counter(i for i, _ in texts) and sum(r.n_exact for r in report) == 5 and sum(r.n_near for r in report) == 0


# Components and near duplicates.


def test_components_at_random(spark):
    rng = random.Random(6)
    check_components(spark, [(rng.randrange(90), rng.randrange(90)) for _ in range(60)])


def test_components_of_a_long_chain_and_a_star(spark):
    check_components(spark, [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(200)])


def check_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long").select(*[F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("i")).alias(c) for c in "ab"])
    got = defaultdict(set)
    for r in components.components(df).collect():
        got[r.root.i].add(r.node.i)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    want = defaultdict(set)
    for x in list(parent):
        want[find(x)].add(x)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def brute_classes(texts, width, percent):
    sets = []
    for _, t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    cls = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if sets[i] and 100 * c >= percent * len(sets[i] | sets[j]):
                old, new = cls[i], cls[j]
                cls = [new if x == old else x for x in cls]
    least = {}
    for (i, _), c in zip(texts, cls, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted((i is None, i or 0, len(s), least.get(c)) for (i, _), s, c in zip(texts, sets, cls, strict=True))


def near_texts():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    texts, i = [], 0
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(30, 150))]
        for _ in range(rng.choice([1, 2, 5, 30])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6, 15])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append((i, " ".join(copy) if rng.random() < 0.8 else "  ".join(copy).upper()))
            i += 1
    return texts + [(900, None), (901, ""), (902, " \n"), (903, "two words"), (904, "Two\tWORDS "), (905, "two other"), (None, "two words"), (903, "two words"), (906, "é É"), (907, "é é")]


@pytest.mark.parametrize(("width", "percent", "block"), [(3, 85, 2000), (5, 80, 8)])
def test_near_classes_against_brute_force(spark, monkeypatch, width, percent, block):
    """Also with groups dealt into blocks of a few documents, and without a broadcast."""
    monkeypatch.setattr(near_dedup, "BLOCK_DOCS", block)
    monkeypatch.setattr(near_dedup, "BROADCAST_CANDIDATES", 10**6 if block > 8 else 0)
    texts = near_texts()
    got = near_dedup.near_classes(docs_of(spark, texts).repartition(6), width, percent).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == brute_classes(texts, width, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_classes_of_nothing(spark):
    assert near_dedup.near_classes(docs_of(spark, [])).count() == 0
    assert near_dedup.one_of_each(docs_of(spark, [(1, None), (2, None)])).count() == 2


def test_pruning_keeps_what_reaches_the_threshold():
    needed = near_dedup.least_matches(0.85, 1e-4)
    assert all(0 < m < n for m, n in zip(needed, range(36, 253, 36), strict=True)) and needed == sorted(needed)
    rng = np.random.default_rng(1)
    matches = np.cumsum(rng.random((20_000, 252)) < 0.85, axis=1)[:, 35::36]
    assert (matches >= needed).all(axis=1).mean() > 0.99


# Packing.


@given(st.text(st.sampled_from("abc  \n\t.,'sé1€ "), max_size=80))
@settings(deadline=None, max_examples=300)
def test_encoding_by_ranks_is_the_tokenizer(text):
    encoder = packing.encoder_for(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))
    assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == encoder.whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_000_000, "\t" * 1_000_001 + "x", "end " + " \n" * 600_000, "\u3000" * 1_000_000, "a" * 1_000_000, "9" * 1_000_000, "!" * 1_000_000, "a " * 300_000 + " " * 100_000 + "b"], ids=range(9))
def test_encoder_takes_long_runs(text):
    encoder = packing.encoder_for(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))
    assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == encoder.whole.encode(text, add_special_tokens=False).ids


def test_packing_of_long_runs_and_broken_text(spark):
    docs = spark.createDataFrame([(1, bytearray(b" " * 1_000_000)), (2, bytearray(b"\xff a \xc3")), (3, bytearray(b"\n" * 1_000_000))], "doc_id long, raw binary").selectExpr("doc_id", "CAST(raw AS STRING) AS text")
    got = packing.packed(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))
    assert {r.doc_id: r.n for r in got.groupBy("doc_id").sum("length").toDF("doc_id", "n").collect()}[1] == 1_000_001 and got.groupBy("sequence_id").sum("length").filter("`sum(length)` > 1024").count() == 0


def check_packed(rows, lengths, capacity):
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_packing(spark):
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choice(["the", "of", "naïve", "x1", "<|endoftext|>"]) for _ in range(rng.choice([1, 5, 20, 60, 200, 700])))) for i in range(300)]
    texts += [(1000, None), (1001, ""), (1002, "  two  spaces "), (None, "no id"), (7, texts[7][1])]
    df = docs_of(spark, texts).repartition(5)
    rows = packing.packed(df, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), capacity=128).collect()
    whole = packing.encoder_for(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken")).whole
    ids = {i: whole.encode(t or "", add_special_tokens=False).ids + [2] for i, t in texts}
    found = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = Counter((i, k, s, n, zlib.crc32(np.array(ids[i][s : s + n], "<u4").tobytes())) for i, _ in texts for k, (s, n) in enumerate(packing.cut(len(ids[i]), 128)))
    assert found == want
    total = sum(r.length for r in rows)
    assert check_packed(rows, None, 128) <= -(-total // 128) * 1.03 + 4
    assert packing.packed(df.limit(0), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken")).count() == 0


@pytest.mark.parametrize("lengths", [[300] * 500, [1] * 900, [1024] * 20 + [512] * 31 + [513] * 10, list(range(1, 1025))])
def test_packing_of_given_lengths(spark, lengths):
    """One length for all, tiny pieces, full pieces and every length."""
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long").repartition(4)
    rows = packing.best_fit(items, 1024).select("item", F.col("seq").alias("sequence_id"), "offset", "length").collect()
    assert sorted(r.item for r in rows) == list(range(len(lengths)))
    least = max(-(-sum(lengths) // 1024), sum(x > 512 for x in lengths), -(-len(lengths) // 3) if lengths[0] == 300 else 0)
    assert check_packed(rows, lengths, 1024) <= least * 1.05 + 5


@pytest.mark.parametrize(("large", "small"), [(600, 1), (524, 17), (955, 5)])
def test_packing_fills_gaps_with_small_pieces(spark, large, small):
    """As many small pieces as the gaps of 20 sequences hold take no further sequence."""
    lengths = [large] * 20 + [small] * (20 * ((1024 - large) // small))
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long").repartition(4)
    rows = packing.best_fit(items, 1024).select("item", F.col("seq").alias("sequence_id"), "offset", "length").collect()
    assert sorted(r.item for r in rows) == list(range(len(lengths))) and check_packed(rows, lengths, 1024) == 20


# Language identification and scores.


def test_forward_adds_up_all_segmentations():
    pieces = language_id.Pieces([b"a", b"b", b" ", b"ab", b" a", b"bab"])
    p = np.array([0.2, 0.3, 0.1, 0.15, 0.05, 0.2])
    vocabulary = dict(zip([b"a", b"b", b" ", b"ab", b" a", b"bab"], p, strict=True))

    def total(s):
        return 1.0 if not s else sum(q * total(s[len(v) :]) for v, q in vocabulary.items() if s.startswith(v))

    words = [b" abab", b" b", b" babab", b"aabbab"]
    at = language_id.forward(words, pieces.hits(words), lambda _, k: p[k][:, None], 1)
    assert [at[len(w), i, 0] for i, w in enumerate(words)] == pytest.approx([total(w) for w in words])
    counts = language_id.expected(words, pieces, p[:, None], np.zeros(4, int), np.ones(4), 1)
    h = 1e-6  # expected counts are the derivatives by the logarithms of the probabilities
    for k, v in enumerate(list(vocabulary)):
        old = vocabulary[v]
        vocabulary[v] = old * (1 + h)
        up = sum(np.log(total(w)) for w in words)
        vocabulary[v] = old
        assert counts[k, 0] == pytest.approx((up - sum(np.log(total(w)) for w in words)) / h, rel=1e-3, abs=1e-6)


def plain_logs(word, vocabulary):
    """Log probability of a word over all segmentations, with logarithms throughout; vocabulary: logarithms by piece."""
    at = [0.0] + [-np.inf] * len(word)
    for end in range(1, len(word) + 1):
        at[end] = np.logaddexp.reduce([at[start] + vocabulary[word[start:end]] for start in range(end) if word[start:end] in vocabulary] or [-np.inf])
    return at[-1]


def test_long_words_of_rare_pieces_stay_in_range(monkeypatch):
    """Words far beyond the smallest float, whole, also with more positions than are held at once."""
    names = [bytes([c]) for c in range(97, 103)] + [b" ", b" a", b"bc", b"abc", b"dddd", b"x"]
    p = np.array([1e-12, 2e-12, 1e-11, 3e-12, 1e-12, 1e-9, 0.5, 0.3, 1e-7, 1e-6, 1e-13, 0.2])
    pieces, logs = language_id.Pieces(names), dict(zip(names, np.log(p), strict=True))
    words = sorted([b" abc", b" " + b"abcdddde" * 8, b" " + b"edcbaf" * 50, b" " + b"d" * 400, b" zz"], key=len)
    want = [plain_logs(w, logs) for w in words]
    with np.errstate(divide="ignore"):
        got = language_id.log_likelihoods(words, pieces, np.stack([p, p], axis=1))
    assert got[:, 0] == pytest.approx(want) and got[:, 1] == pytest.approx(want) and want[0] == -np.inf and want[-1] < -2000
    counts = language_id.expected(words, pieces, p[:, None], np.zeros(5, int), np.arange(1.0, 6), 1)
    sizes = np.array([len(x) for x in names])
    assert (counts[:, 0] * sizes).sum() == pytest.approx(sum(k * len(w) for k, w in enumerate(words, 1) if b"z" not in w))  # every byte is in one piece
    monkeypatch.setattr(language_id, "SPAN", 16)
    assert language_id.expected(words, pieces, p[:, None], np.zeros(5, int), np.arange(1.0, 6), 1) == pytest.approx(counts)


def test_pieces_of_any_length_are_used():
    names = [bytes([c]) for c in range(256)] + [b" responsibilities", b"-" * 64]
    p = np.r_[np.full(256, 0.002), 0.3, 0.188]
    pieces, logs = language_id.Pieces(names), dict(zip(names, np.log(p), strict=True))
    words = [b" responsibilities", b" " + b"-" * 100]
    assert language_id.log_likelihoods(words, pieces, p[:, None])[:, 0] == pytest.approx([plain_logs(w, logs) for w in words])


def test_rare_script_beside_a_million_words(spark):
    """A run of Burmese seen once in a language of a million training pieces."""
    run = "".join(chr(0x1000 + i) for i in range(21))  # 63 bytes
    rows = [("en", "the " * 1_000_000 + run), ("de", "der und nicht " * 50)]
    model = language_id.learned(spark.createDataFrame(rows, "lang string, text string"), path("byte_bpe_50k.tiktoken"))
    assert np.isfinite(model.probability).all() and model.probability.sum(axis=0) == pytest.approx([1, 1])
    asked = spark.createDataFrame([(0, "the the"), (1, "der und"), (2, run * 3)], "k int, text string")
    got = {r.k: (r.lang_pred, r.score) for r in language_id.predicted(asked, model).collect()}
    vocabulary = language_id.rank_file_vocabulary(path("byte_bpe_50k.tiktoken"))
    logs = [plain_logs(b" " + (run * 3).encode(), dict(zip(vocabulary, c, strict=True))) for c in np.log(model.probability.T)]
    assert [got[k][0] for k in range(2)] == ["en", "de"] and got[2][0] == model.languages[int(np.argmax(logs))]
    assert got[2][1] == pytest.approx(1 / np.exp(np.maximum(np.array(logs) - max(logs), -700)).sum())


def language_docs():
    rng, texts, langs = random.Random(4), [], {}
    words = {"en": "the of and thing ation with heed".split(), "de": "der und schöne gekeit nicht für".split(), "fr": "le une été quelle ment dans".split()}
    for i in range(300):
        lang = rng.choice(list(words))
        langs[i] = lang
        texts.append((i, " ".join(rng.choice(words[lang]) + rng.choice(["", "", ".", rng.choice("aeiou")]) for _ in range(rng.randint(5, 60)))))
    return texts, langs


def test_language_id(spark):
    texts, langs = language_docs()
    extra = [(1000, None), (1001, "123 !?"), (1002, ""), (1003, "the " * 30_000), (None, "der und schöne"), (1004, "w" * 5000)]
    langs |= {i: None for i, _ in extra}
    df = docs_of(spark, texts + extra, langs)
    got = {r.doc_id: r for r in language_id.language_id(df, path("byte_bpe_50k.tiktoken")).collect()}
    assert len(got) == len(texts + extra)
    held = [i for i, _ in texts if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (i in held) for i, _ in texts) and held
    assert np.mean([got[i].lang_pred == langs[i] for i in held]) > 0.97
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "en", "de"] and got[1004].lang_pred in ("de", "en", "fr")
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = language_id.language_id(docs_of(spark, texts[:5], {i: None for i in range(5)}), path("byte_bpe_50k.tiktoken"))
    assert {r.lang_pred for r in nothing.collect()} == {"und"} and language_id.language_id(df.limit(0), path("byte_bpe_50k.tiktoken")).count() == 0


def test_scores(spark):
    texts, _ = language_docs()
    texts += [(1000, None), (1001, ""), (1002, "never seen words"), (3, texts[3][1])]
    df = docs_of(spark, texts)
    got = lm_score.lm_scores(df, top=20, rare=4, dictionary=30, size=8).collect()
    assert len(got) == len(texts)
    training = [t for i, t in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in training for w in (t or "").encode().lower().split() + [b"\n"])
    n, v, text = sum(counts.values()), len(counts), dict(texts)
    for r in got:
        words = (text[r.doc_id] or "").encode().lower().split() + [b"\n"]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in counts for w in words), n)
        assert r.base_score == pytest.approx(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        assert r.score < 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm_score.lm_scores(df.limit(0)).count() == 0


def test_probabilities_add_up(spark):
    """Over all known tokens and the unseen one of each rare unit, for several contexts of a trained model."""
    texts, _ = language_docs()
    df = docs_of(spark, texts)
    counts = lm_score.word_counts(df.select("text"), end=lm_score.END).select("word", "n")
    d = lm_score.dictionary_of(counts, 20, 4, 10**6)
    look, scorer = lm_score.tools(d, lm_score.trained(df.select("doc_id", "text"), d, 8))
    words = len(d.counts)
    assert d.units == 24 and len(scorer.bounds) > 3
    target = np.r_[look.unit[:words], d.rare_units].astype(np.int32)
    inside = look.one_in_unit[target] + np.r_[look.within[:words], np.zeros(d.rare)]
    for near, far in ((0, d.units), (3, 1), (d.units, d.units), (21, 5)):
        logs = scorer.logs(target, np.full(len(target), near), np.full(len(target), far)) / lm_score.LOG10
        assert (10 ** (logs + inside)).sum() == pytest.approx(1, abs=1e-4)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 500)
    texts, _ = language_docs()
    df = docs_of(spark, [*texts, (3, texts[3][1])])
    one, more = ({r.doc_id: r.score for r in lm_score.lm_scores(x).collect()} for x in (df.coalesce(1), df.repartition(7)))
    assert one == pytest.approx(more, rel=1e-5)


def test_units_grow_with_the_corpus(spark):
    sizes = []
    for n in (400, 40_000):
        counts = spark.range(n).selectExpr("encode(concat('w', id), 'UTF-8') AS word", "1L + CAST(1000 / (id + 1) AS BIGINT) AS n")
        d = lm_score.dictionary_of(counts, None, None, 100)
        assert d.tokens.sum() == d.n_tokens and d.words.sum() == d.n_words == n and len(d.top_units) == min(n, int(d.n_tokens**0.5) + 1)
        sizes.append(d.units)
        bounds = lm_score.class_bounds(d.units)
        assert bounds[-1] == d.units and (np.diff(bounds) > 0).all()
    assert sizes[1] > 2 * sizes[0] - 64
