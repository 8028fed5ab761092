"""A training corpus from `documents`: language, lines, near duplicates, mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last
return the columns of documents, extra ones too; between stages the rows are a Parquet table. Extra columns may have any names.
An empty table goes through all stages as an empty table. What else a stage does with nulls, repeated rows and ties stands there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymart.llm.common import known_to_workers
from tallymart.llm.language_id import identified, language_model
from tallymart.llm.line_dedup import deduplicated
from tallymart.llm.mixing import mixed
from tallymart.llm.near_dedup import one_of_each
from tallymart.llm.packing import packed
from tallymart.llm.queries import RANKS, TOKENIZER, vocabulary
from tallymart.tables import new_path, remove, scratch

#: Part of the way from a share that fits all languages alike to a share of one at which a text is of a language.
CLEAR = 2 / 15


def least_score(languages: int) -> float:
    """Score (mean likelihood of a word, the best language's share) below which a text is of no language in particular.

    Of four languages that fit alike each has 0.25 and 0.35 is asked for; short texts of one of them reach 0.37. Of two, 0.57.
    """
    equal = 1 / max(languages, 1)
    return equal + CLEAR * (1 - equal)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without a clear language go.

    A null or empty text has no letter. Rows with null language are judged but not learned from; where nothing can be learned every
    document goes. Repeated rows are judged alike; of languages with equal likelihood the smaller name is taken.
    """
    model = language_model(docs, vocabulary(RANKS))
    return identified(docs, model, least_score(len(model.languages)))


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand elsewhere before, equal or within two edits, go; so do documents left without a line.

    Before means by identifier (null first), then by row where an identifier is repeated, then by place. Of repeated rows one thus keeps its
    lines. A null text stays null, lines of under 20 bytes stay. n_chars is that of the new text.
    """
    return deduplicated(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of 5-word shingles with similarity 0.8 or more stays: that with the smallest identifier.

    Texts without a word (null ones too) are in no class and stay. Rows with the smallest identifier that are repeated all stay; a null
    identifier stays only where its class has no other.
    """
    return one_of_each(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for.

    Null is a source of its own and the last by name. A source without words has rate 0 and goes. Repeated rows with one
    identifier get the same number of copies each; a null identifier draws as one.
    """
    return mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of 1024 tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is its end token alone. Repeated rows and null identifiers are packed as often as they occur.
    """
    return packed(docs, vocabulary(TOKENIZER), vocabulary(RANKS))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_lines),
    ("near_dedup", remove_near_duplicates),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Language scores, near-duplicate classes and packing have no SQL form; see tests/llm for the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. A stage's own tables and the rows it was given are removed when its result is written."""
    docs, old = known_to_workers(spark).read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, name)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if old:
            remove(spark, old)
        docs, old = spark.read.parquet(path), path
    return docs
