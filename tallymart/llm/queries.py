"""One query for each training-data operator, over whole tables, and its DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymart.llm.archives import archived
from tallymart.llm.common import known_to_workers
from tallymart.llm.exact_dedup import exact_dedup
from tallymart.llm.language_id import language_id
from tallymart.llm.lexical_search import ranked
from tallymart.llm.line_dedup import line_report
from tallymart.llm.lm_score import lm_scores
from tallymart.llm.mixing import mix_plan
from tallymart.llm.near_dedup import near_classes
from tallymart.llm.packing import packed
from tallymart.llm.piece_counts import piece_counts
from tallymart.llm.quality_rules import judged
from tallymart.llm.vector_search import nearest
from tallymart.llm.whitening import whitened

#: The public vocabulary of the counting, packing and language operators; a parameter of each.
RANKS, TOKENIZER = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return known_to_workers(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"), width=3, percent=85)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"))


def op5_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts(table(spark, sf_dir, "documents"), vocabulary(RANKS))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), vocabulary(TOKENIZER), vocabulary(RANKS))


def op7_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"), vocabulary(RANKS))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("rejected_by", ",").alias("rejected_by"))


def op11_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


SQL = {
    # A pair within two edits keeps one third of either line whole: the cheap test before the distance.
    "op1_line_dedup": """
WITH t AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS pos FROM t),
e AS (SELECT * FROM l WHERE strlen(line) >= 20),
d AS (SELECT line, strlen(line) AS n, length(line) // 3 AS third, doc_id AS d, pos AS p FROM e
      QUALIFY row_number() OVER (PARTITION BY line ORDER BY doc_id NULLS FIRST, pos) = 1),
c AS (SELECT *, n + k AS m FROM d, (SELECT unnest([-2, -1, 0, 1, 2]) AS k)),
k AS (SELECT a.d AS ad, b.d AS bd, b.line AS late
      FROM c a JOIN d b ON a.m = b.n AND (a.d < b.d OR (a.d = b.d AND a.p < b.p))
      WHERE (contains(b.line, substr(a.line, 1, a.third)) OR contains(b.line, substr(a.line, a.third + 1, a.third)) OR contains(b.line, substr(a.line, 2 * a.third + 1)))
        AND levenshtein(a.line, b.line) <= 2),
v AS (SELECT e.doc_id, e.pos, e.line IN (SELECT late FROM k) AS near, NOT (e.doc_id = d.d AND e.pos = d.p) AS again FROM e JOIN d USING (line)),
r AS (SELECT doc_id, count(*) FILTER (NOT near) AS n_exact, count(*) FILTER (near) AS n_near, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS removed
      FROM v WHERE near OR again GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_links FROM (SELECT ad AS doc_id FROM k UNION ALL SELECT bd FROM k) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
       coalesce(removed, '') AS removed, coalesce(n_links, 0) AS n_links
FROM t LEFT JOIN r USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op2_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op3_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.least AS component_id, d.doc_id = m.least AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS least FROM r GROUP BY a) m ON m.a = d.doc_id""",
    "op4_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS INT) + 1] AS weight
  FROM s),
r AS (
  SELECT source, source_size, weight, row_number() OVER up AS place,
         (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (up ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW up AS (ORDER BY source_size / weight, source NULLS LAST)),
f AS (SELECT place, level FROM r WHERE level * weight <= 2.0::DOUBLE * source_size ORDER BY place LIMIT 1),
t AS (
  SELECT r.source, r.source_size,
         CASE WHEN f.place IS NULL OR r.place < f.place THEN 2.0::DOUBLE * r.source_size ELSE f.level * r.weight END AS target
  FROM r LEFT JOIN f ON true),
q AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM t),
hex AS (SELECT *, substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS h FROM d),
u AS (
  SELECT doc_id, source, size,
         list_sum([(instr('0123456789abcdef', substr(h, i, 1)) - 1) * pow(16, 8 - i) for i in range(1, 9)]) / 4294967296.0::DOUBLE AS draw
  FROM hex)
SELECT u.doc_id, u.size, q.source_size, q.target,
       CAST(u.size * (floor(q.rate) + CASE WHEN u.draw < q.rate - floor(q.rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM u JOIN q ON u.source IS NOT DISTINCT FROM q.source""",
    "op7_arc_to_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (
  SELECT page_id, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS first,
         array_to_string([['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
                          [instr('0123456789abcdef', substr(sha1(h), i, 1))] FOR i IN range(1, 41)], '') AS bits
  FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + list_sum([CAST(substr(bits, 5 * k + j, 1) AS INT) * pow(2, 5 - j) FOR j IN range(1, 6)]) AS INT), 1) FOR k IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM q""",
    "op11_vector_search": """
WITH v AS (SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x
           FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10""",
    "op12_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
dn AS (SELECT d, doc_id, ts, len(ts) AS n FROM d WHERE len(ts) > 0),
c AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS length FROM dn),
i AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM benchmark),
it AS (SELECT i, term, count(*) AS q FROM (SELECT i, unnest(ts) AS term FROM i) GROUP BY ALL),
p AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(ts) AS term FROM dn) WHERE term IN (SELECT term FROM it) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * c.docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c),
m AS (SELECT d, doc_id, 100 - 75 + ((75 * n * c.docs) // c.length) AS m FROM dn, c),
s AS (
  SELECT it.i, m.doc_id, m.d, CAST(sum(it.q * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * m.m))) AS BIGINT) AS score
  FROM it JOIN w USING (term) JOIN p USING (term) JOIN m USING (d) GROUP BY ALL),
r AS (SELECT i, doc_id, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r JOIN i USING (i) WHERE rank <= 10""",
}
