"""Exact deduplication, mixing, piece counts, archives and quality rules against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tallymart.llm import archives, exact_dedup, mixing, piece_counts, quality_rules

DOCS = "doc_id long, text string, lang string, source string, run int, digest string"


def rows(spark, texts, lang="en", source="s"):
    """Extra columns carry names that operators use themselves."""
    return spark.createDataFrame([(i, t, lang, source, 1, "x") for i, t in texts], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


# Exact deduplication.


def test_exact_dedup_groups(spark):
    texts = [(1, "a"), (5, "a"), (3, "b"), (2, None), (7, ""), (9, "a "), (4, "a"), (None, "b")]
    got = {(r.doc_id, r.text_sha256[:6]): r for r in exact_dedup.exact_dedup(rows(spark, texts).repartition(4), fan_in=2).collect()}
    h = lambda t: hashlib.sha256(t.encode()).hexdigest()[:6]
    assert {k: (r.keep_id, r.group_size, r.kept) for k, r in got.items()} == {
        (1, h("a")): (5, 3, False), (5, h("a")): (5, 3, True), (4, h("a")): (5, 3, False), (3, h("b")): (3, 2, True), (None, h("b")): (3, 2, False),
        (2, h("")): (7, 2, False), (7, h("")): (7, 2, True), (9, h("a ")): (9, 1, True),
    }


def test_exact_dedup_repeated_rows_keep_one(spark):
    got = exact_dedup.exact_dedup(rows(spark, [(1, "x"), (1, "x"), (1, "x")]).repartition(3)).collect()
    assert [r.group_size for r in got] == [3, 3, 3] and sum(r.kept for r in got) == 1


def test_exact_dedup_hot_group_and_empty(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t', id % 700) END AS text").repartition(9)
    got = exact_dedup.exact_dedup(docs, fan_in=2)
    assert got.filter("text_sha256 = sha2('hot', 256)").selectExpr("min(group_size)", "max(group_size)", "max(keep_id)", "count_if(kept)").first()[:] == (1000, 1000, 2997, 1)
    assert got.count() == 3000
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0
    assert exact_dedup.drop_duplicates(docs).count() == got.filter("kept").count()


@given(st.lists(st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(0, 50)), max_size=8), max_size=6))
@settings(deadline=None, max_examples=50)
def test_merge_runs_is_a_group_by(runs):
    entries, row = [], 0
    for run in runs:
        made = []
        for d, i in run:
            made.append((d, 1, 1, True, i, row, 1))
            row += 1
        entries.append(sorted(made))
    want = defaultdict(list)
    for run in entries:
        for e in run:
            want[e[0]].append(e)
    got = exact_dedup.merge_runs(entries)
    assert [(e[0], e[3:6], e[6]) for e in got] == [(k, max(x[3:6] for x in v), len(v)) for k, v in sorted(want.items())]


def test_exact_dedup_of_one_partition_merges_runs(spark):
    docs = rows(spark, [(i, f"t{i % 50}") for i in range(400)]).coalesce(1)
    runs = exact_dedup.digest_runs(docs)
    sorted_runs = exact_dedup.sorted_runs(runs, 4).collect()
    assert len({r.run for r in sorted_runs}) == exact_dedup.LEAST_RUNS and all([tuple(e) for e in r.entries] == sorted(tuple(e) for e in r.entries) for r in sorted_runs)
    for fan_in in (2, 3, 16):
        got = exact_dedup.exact_dedup(docs, fan_in=fan_in).selectExpr("count(*)", "count_if(kept)", "min(keep_id)", "max(keep_id)", "min(group_size)").first()
        assert got[:] == (400, 50, 350, 399, 8)


# Mixing.


def water_fill(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by dealing out the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > most * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in free}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_mixing_targets_and_copies(spark):
    rng = random.Random(3)
    docs, i = [], 0
    for s, n in (("b", 40), ("a", 400), (None, 30), ("é", 25), ("c", 5), ("z", 1)):
        for _ in range(n):
            docs.append((i, " ".join("w" * rng.randint(0, 30)) if s != "z" else None, "en", s, 1, "x"))
            i += 1
    df = spark.createDataFrame(docs, DOCS)
    sizes = defaultdict(int)
    for d in docs:
        sizes[d[3]] += len((d[1] or "").split())
    want = water_fill(dict(sizes))
    got = mixing.mix_plan(df).collect()
    source = {d[0]: d[3] for d in docs}
    assert len(got) == len(docs)
    for r in got:
        assert r.target == pytest.approx(want[source[r.doc_id]]) and r.source_size == sizes[source[r.doc_id]] and 0 <= r.taken <= 2 * r.size
        rate = want[source[r.doc_id]] / r.source_size if r.source_size else 0
        assert r.size == 0 or r.taken / r.size in (int(rate), int(rate) + 1)
    taken = sum(r.taken for r in got if source[r.doc_id] == "a")
    assert taken == pytest.approx(want["a"], rel=0.15)
    assert sorted(got) == sorted(mixing.mix_plan(df.repartition(7)).collect())
    copies = Counter(r.doc_id for r in mixing.mixed(df).collect())
    assert all(copies[r.doc_id] * r.size == r.taken for r in got)
    assert mixing.mixed(df).columns == df.columns


def test_mixing_empty(spark):
    assert mixing.mix_plan(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0
    assert mixing.mix_plan(rows(spark, [(1, None), (2, " ")])).filter("taken <> 0 OR target <> 0").count() == 0


# Piece counts.

LETTERS = [bytes([i]) for i in range(256)]


def greedy(word, vocabulary):
    n = at = 0
    longest = max(map(len, vocabulary))
    while at < len(word):
        at += next(k for k in range(longest, 0, -1) if word[at : at + k] in vocabulary and at + k <= len(word))
        n += 1
    return n


@given(st.sets(st.text("abc", min_size=2, max_size=6), max_size=12), st.lists(st.text("abcd", max_size=20), max_size=20))
@settings(deadline=None, max_examples=150)
def test_automaton_is_greedy_longest_match(pieces, words):
    vocabulary = {p.encode() for p in pieces} | set(LETTERS)
    automaton = piece_counts.Automaton(sorted(vocabulary))
    assert [automaton.count(w.encode()) for w in words] == [greedy(w.encode(), vocabulary) for w in words]


def test_piece_counts_of_documents(spark):
    import public_tokenizers

    path = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    vocabulary = set(piece_counts.rank_file_vocabulary(path))
    texts = [(1, "Hello  world\n naïve été"), (2, None), (3, ""), (None, "a" * 20_000), (5, "über " * 2000), (5, "über " * 2000)]
    got = sorted(tuple(r) for r in piece_counts.piece_counts(rows(spark, texts), path).selectExpr("coalesce(doc_id, -1)", "n_words", "n_pieces", "n_bytes").collect())
    want = sorted((-1 if i is None else i, len((t or "").encode().split()), sum(greedy(b" " + w, vocabulary) for w in (t or "").encode().split()), len((t or "").encode())) for i, t in texts)
    assert got == want
    assert piece_counts.piece_counts(empty(spark), path).count() == 0


# Archives.


def test_arc_versions_and_lengths():
    records = [("http://a/b%20c", "20010203040506", "text/html", b"HTTP/1.1 200 OK\r\n\r\nline\nWARC/1.1 \x00\xff\n\n"), ("urn:null", "20010203040507", "text/html", b""), ("http://a b", "20010203040508", "text/html; charset=x", b"1 2 3\n")]
    for version in (1, 2):
        first, *got = archives.read_arc_bytes(archives.arc_bytes(version, "x.arc", iter(records)))
        assert [(r.url, r.date, r.mime, r.block) for r in got] == records and first.block == archives.HEAD[version]
        assert got[0].more == ({"ARC-Result-Code": "200"} if version == 2 else {})
    broken = archives.arc_bytes(1, "x.arc", iter(records))
    for data in (broken[:-20], broken.replace(b" 20010203040506 ", b" 2001 "), broken.replace(b"1 0 tallymart", b"7 0 tallymart")):
        with pytest.raises(ValueError):
            list(archives.read_arc_bytes(data))


def test_warc_fields(spark):
    """A version 2 file with a page, its copy and a capture without HTTP, all told apart; a version 1 file with an equal payload."""
    page = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\nsame payload"
    made = [("http://a/1", "20010203040506", "text/html", page), ("dns:a", "20010203040507", "text/dns", b"a 1 IN A 1.2.3.4"), ("http://a/1", "20010203040506", "text/html", page)]
    two = archives.arc_bytes(2, "two.arc", iter(made)).replace(b"dns:a 0.0.0.0", b"dns:a 9.9.9.9").replace(b"200 - - ", b"404 abc http://b ")
    one = archives.arc_bytes(1, "one.arc", iter(made[:1]))
    df = spark.createDataFrame([("two.arc", bytearray(two)), ("one.arc", bytearray(one))], "name string, content binary").repartition(2)
    got = [next(archives.read_warc_bytes(r.record.encode() + b"\r\n\r\n")) for r in archives.arc_to_warc(df).collect()]
    kinds = Counter(h["warc-type"] for h, _ in got)
    assert kinds == {"warcinfo": 2, "response": 1, "revisit": 2, "resource": 1} and len({h["warc-record-id"] for h, _ in got}) == 6
    info = {h["warc-filename"]: h["warc-record-id"] for h, _ in got if h["warc-type"] == "warcinfo"}
    dns = next(h for h, _ in got if h["warc-type"] == "resource")
    assert (dns["content-type"], dns["warc-ip-address"], dns["arc-result-code"], dns["arc-checksum"], dns["arc-location"], dns["warc-warcinfo-id"]) == ("text/dns", "9.9.9.9", "404", "abc", "http://b", info["two.arc"])
    whole = next(h for h, _ in got if h["warc-type"] == "response")
    for h, block in got:
        if h["warc-type"] == "revisit":
            assert (h["warc-refers-to"], h["warc-refers-to-target-uri"], h["warc-refers-to-date"], h["warc-payload-digest"]) == (whole["warc-record-id"], "http://a/1", "2001-02-03T04:05:06Z", whole["warc-payload-digest"])
            assert block.endswith(b"\r\n\r\n") and b"payload" not in block


def test_warc_round_trip(spark):
    pages = [(1, "http://a", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (9, None, None), (4, "http://a b", ""), (5, "u", "one\r\n\r\nWARC/1.1"), (3, "http://c", "<p>é</p>"), (None, "u", "<p>é</p>"), (5, "u", "one\r\n\r\nWARC/1.1")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string").repartition(3)
    got = sorted(((r.page_id is not None, r.page_id or 0), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archives.archived(df).collect())
    top = {}
    for i, _, h in pages:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = sorted(((i is not None, i or 0), len((h or "").encode()), archives.sha1((h or "").encode()), "response" if i == top[h or ""] else "revisit", None if i == top[h or ""] else top[h or ""]) for i, _, h in pages)
    assert got == want
    small = {r.page_id: r.record_type for r in archives.archived(df.filter("page_id IS NOT NULL"), least_bytes=9).collect()}
    assert small == {1: "revisit", 2: "revisit", 3: "response", 9: "response", 4: "response", 5: "response"}
    assert archives.archived(df.limit(0)).count() == 0


def test_warc_decisions_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(archives, "BROADCAST_REVISITS", 0)
    df = spark.range(2000).selectExpr("id AS page_id", "concat('http://', id) AS url", "IF(id % 3 = 0, 'hot', concat('p', id % 900)) AS html").repartition(5)
    got = archives.archived(df).selectExpr("count(*)", "count_if(record_type = 'response')", "count_if(payload_digest = '%s' AND refers_to = 1998)" % archives.sha1(b"hot")).first()
    top = {}
    for i in range(2000):
        top["hot" if i % 3 == 0 else i % 900] = i
    assert got[:] == (2000, len(top), 666)


# Quality rules.


def brute_measures(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) for j in range(i, i + 3) if windows[tuple(words[i : i + 3])] > 1}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


@given(st.text(st.sampled_from("ab \n#é <"), max_size=60))
@settings(deadline=None, max_examples=300)
def test_measures(text):
    assert quality_rules.measure(text.encode()) == brute_measures(text)


def test_exact_binomial_bound():
    assert quality_rules.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05**0.01, abs=1e-9)
    assert quality_rules.upper_bound(10, 10, 0.05) == 1.0
    from math import comb

    p = quality_rules.upper_bound(3, 50, 0.01)
    assert sum(comb(50, i) * p**i * (1 - p) ** (50 - i) for i in range(4)) == pytest.approx(0.01, abs=1e-9)


def test_quality_verdicts(spark):
    clean = [(i, " ".join(f"word{i}x{j}" for j in range(60))) for i in range(1500)]
    noisy = [(5000 + i, " ".join(f"w{i}x{j}$$$%%%" for j in range(60))) for i in range(50)]
    short = [(9000, "too short"), (9001, None), (9002, "same three words " * 40)]
    docs = rows(spark, clean + noisy + short)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1500)] + [(0, 1, 0), (5000, 0, 0), (777777, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_rules.judged(docs, labels).collect()}
    assert len(got) == len(clean + noisy + short)
    assert all(got[i].kept for i, _ in clean) and not any(got[i].kept for i, _ in noisy)
    assert all(got[i].base_failed and not got[i].kept for i, _ in short)
    none = quality_rules.judged(docs, labels.limit(0))
    assert none.filter("kept = base_failed").count() == 0
    assert quality_rules.judged(empty(spark), labels).count() == 0


def test_base_columns_of_the_table(spark, sf_dir):
    """The query's base columns on a whole table against the plain version."""
    from tallymart.llm import queries

    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op10_quality_rules(spark, sf_dir).collect()
    assert len(got) == len(text)
    for r in got:
        n, *want = brute_measures(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *want)
        assert r.base_failed == (n < 50 or 100 * want[-1] > 50 * n) and not (r.kept and r.base_failed)


def test_the_risk_holds_in_simulation():
    """Two rules, the second's cutoff chosen after the first's from the same labels; good documents would lose 1 % a step."""
    rng, risk, delta, broken, chosen = np.random.default_rng(12), 0.05, 0.1, 0, 0
    ladder, level = [0.99, 0.98, 0.97, 0.96, 0.95, 0.94, 0.93], 0.1 / 64
    for _ in range(400):
        good, bad = rng.random((1500, 2)), rng.random((300, 2))
        gone, caught, cuts = np.zeros(1500, bool), np.zeros(300, bool), []
        for k in range(2):
            rejected = [int((gone | (good[:, k] > c)).sum()) for c in ladder]
            cut = quality_rules.chosen_cutoff(rejected, [int((~caught & (bad[:, k] > c)).sum()) for c in ladder], 1500, ladder, risk, level)
            if cut is not None:
                gone, caught = gone | (good[:, k] > cut), caught | (bad[:, k] > cut)
                cuts.append(cut)
        broken += 1 - np.prod(cuts) > risk
        chosen += len(cuts)
    assert broken <= delta * 400 and chosen > 400


def test_chosen_cutoff():
    ladder, pick = [9.0, 8.0, 7.0, 6.0], quality_rules.chosen_cutoff
    assert pick([0, 10, 300, 900], [1, 2, 3, 4], 10_000, ladder, 0.05, 1e-4) == 7.0
    assert pick([0, 10, 300, 300], [1, 2, 2, 2], 10_000, ladder, 0.05, 1e-4) == 8.0  # stricter ones catch no more
    assert pick([0, 600, 0, 0], [1, 2, 3, 4], 10_000, ladder, 0.05, 1e-4) == 9.0  # nothing beyond a failure counts
    assert pick([0] * 4, [0] * 4, 10_000, ladder, 0.05, 1e-4) is None
    assert pick([0] * 4, [1] * 4, 0, ladder, 0.05, 1e-4) is None and pick([0] * 4, [1] * 4, 50, ladder, 0.05, 1e-4) is None


def test_rules_together_keep_the_risk(spark):
    """Each rule alone would reject 4 of 100 good documents, both together 8: only one may."""
    measures = spark.range(1100).selectExpr(
        "id AS doc_id", "'a' AS stratum", "100L AS n_words", "500L AS word_chars", "IF(id % 25 = 0 OR id >= 1000, 90L, 0L) AS n_symbols", "0L AS n_dup_lines", "IF(id % 25 = 1 OR id >= 1090, 48L, 0L) AS n_repeat_words"
    )
    labels = spark.range(1100).selectExpr("id AS doc_id", "IF(id < 1000, 1, 0) AS quality")
    got = {r.rule: r.cutoff for r in quality_rules.cutoffs(measures, labels, risk=0.08).collect()}
    assert got == {"symbols_a_word": 0.5}
