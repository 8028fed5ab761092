"""The pipeline, stage by stage and as a whole, against plain versions; language verdicts are taken as given."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallymart.llm import language_id, packing
from tests.llm.test_large_operators import brute_classes, brute_lines, check_packed, language_docs, path
from tests.llm.test_small_operators import water_fill

corpus_pipeline = pytest.importorskip("corpus_pipeline")
#: Extra columns have names that helper columns might have.
COLUMNS = "doc_id long, text string, lang string, source string, n_chars int, _p string, _id long, _row string, _gone int, _stays string, score double, run int"


def table(spark, rows, folder):
    spark.createDataFrame([(*r, "p", 1, "r", 2, "s", 0.5, 3) for r in rows], COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def fixture():
    rng = random.Random(21)
    texts, langs = language_docs()
    words = [f"wort{i}" for i in range(300)]
    long = {k: " ".join(rng.choice(words) for _ in range(60)) for k in range(6)}
    rows = [(i, f"{t}\nline {i} of its own {langs[i]} und the {rng.randrange(10**9)}", langs[i], f"src{i % 4}" if i % 9 else None) for i, t in texts[:120]]
    for k, t in long.items():  # near copies of one line each, in texts with a line of their own
        for j in range(3):
            changed = t.split()
            changed[rng.randrange(60)] = "anders" * (j + 1)
            rows.append((1000 + 10 * k + j, " ".join(changed), "de", "src1"))
    rows += [(2000, "12345 !!!", "en", "src0"), (2001, rows[0][1], "en", "src2"), (2002, None, "en", "src2"), (2003, "", None, "src3"), (2004, "the " * 3000 + "\nthe end of the the thing", "en", "src3"), (2005, "der und die nicht\nder und die nicht", None, "src1")]
    return [(i, t, lang, source, len(t or "")) for i, t, lang, source in rows]


def mixed_copies(rows):
    """Copies of each document: floor of its source's rate and one more by the draw."""
    size = {r.doc_id: len((r.text or "").split()) for r in rows}
    of_source = defaultdict(int)
    for r in rows:
        of_source[r.source] += size[r.doc_id]
    target, out = water_fill(dict(of_source)), {}
    for r in rows:
        rate = target[r.source] / of_source[r.source] if of_source[r.source] else 0
        draw = int(hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest()[:8], 16) / 2**32
        out[r.doc_id] = int(rate) + (draw < rate - int(rate))
    return out


def test_pipeline_against_plain_versions(spark, tmp_path):
    docs = table(spark, fixture(), tmp_path)
    names, given = docs.columns, [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        given.append(docs.collect())
        assert k == 4 or docs.columns == names
    all_docs, clear, lines, classes, mix, packed = given

    model = language_id.language_model(spark.read.parquet(f"{tmp_path}/documents.parquet"), path("byte_bpe_50k.tiktoken"))
    verdicts = {r.doc_id: r for r in language_id.predicted(spark.createDataFrame([(r.doc_id, r.text) for r in all_docs], "doc_id long, text string"), model).collect()}
    assert Counter(clear) == Counter(r for r in all_docs if verdicts[r.doc_id].lang_pred != "und" and verdicts[r.doc_id].score >= corpus_pipeline.least_score(len({r.lang for r in all_docs if r.lang})))
    assert {r.doc_id for r in all_docs} - {r.doc_id for r in clear} == {2000, 2002, 2003}

    gone, want = brute_lines([(r.doc_id, r.text) for r in clear], 20, 2), {}
    for r in clear:
        left = [x for i, x in enumerate(r.text.split("\n")) if i not in gone.get(r.doc_id, ())]
        if left:
            want[r.doc_id] = "\n".join(left)
    assert {r.doc_id: r.text for r in lines} == want and all(r.n_chars == len(r.text) for r in lines) and 2001 not in want

    least = {i: c for _, i, _, c in brute_classes([(r.doc_id, r.text) for r in lines], 5, 80)}
    assert Counter(classes) == Counter(r for r in lines if least[r.doc_id] == r.doc_id) and len(classes) < len(lines)

    copies = mixed_copies(classes)
    assert Counter(mix) == Counter({r: copies[r.doc_id] for r in classes if copies[r.doc_id]})

    whole, pieces = packing.encoder_for(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken")).whole, Counter()
    for r in mix:
        ids = whole.encode(r.text, add_special_tokens=False).ids + [2]
        pieces.update((r.doc_id, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 1024)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces
    assert check_packed(packed, None, 1024) <= -(-sum(r.length for r in packed) // 1024) + 2

    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in run) == pieces


def test_pipeline_of_repeated_rows_and_null_identifiers(spark, tmp_path):
    """Rows of one identifier keep what is their own; of equal rows one keeps its lines."""
    own = [f"der und die nicht und wort{i} der {i * 7919} und die schöne" for i in range(8)]
    rows = [(None, own[0], "de", "a", 1), (None, own[1], "de", "a", 1), (5, own[2], "de", None, 1), (5, own[3], "de", None, 1), (7, own[4], "de", "b", 1), (7, own[4], "de", "b", 1), *[(10 + i, own[5 + i], "de", "b", 1) for i in range(3)]]
    docs = table(spark, rows, tmp_path)
    stages = dict(corpus_pipeline.STAGES)
    clear = stages["language_id"](spark, docs, str(tmp_path))
    lines = stages["line_dedup"](spark, clear, str(tmp_path))
    assert clear.count() == len(rows) and Counter(r.text for r in lines.collect()) == Counter(own)
    assert Counter(r.text for r in stages["near_dedup"](spark, lines, str(tmp_path)).collect()) == Counter(own)
    assert stages["mix_sources"](spark, lines, str(tmp_path)).columns == docs.columns


def test_pipeline_of_an_empty_table(spark, tmp_path):
    table(spark, [], tmp_path)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
