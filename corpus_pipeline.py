"""From raw documents to packed sequences: five stages, each written as a table that the next one reads.

Quality rules and the quality classifier drop documents, near-duplicate removal keeps one document of each group,
personal data is masked in place, and packing returns the pieces of the sequences.

Defined cases: a null or empty text fails the rules, so it never reaches the later stages; texts of any length are taken
whole; repeated rows and ids are each judged by their own text, and one row of each group of near duplicates stays (the
least id; of equal ids the least text); rows with a null doc_id go through all stages, are dropped as duplicates where a row
with an id has the same words, and are packed first among equal keys; other columns pass through unchanged, whatever their
names, up to packing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from beadloom.llm import near_dup, packing, pii, pu, quality_rules
from beadloom.llm.common import materialise, table
from beadloom.llm.queries import tokenizer_file


#: The quality score below which a document goes: where op2_quality_pu predicts 0.
SURE = 0.5


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule policy keeps."""
    return quality_rules.keep(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents but those that the classifier predicts as bad.

    It learns from the raw table: behind the rules hardly any bad text is left to learn from.
    """
    raw, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = pu.learn(raw, labels, "quality", pu.fold(3) != 1, pu.QUALITY)
    return pu.keep(docs, model, SURE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_dup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 ids."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules),
    ("quality_classifier", quality),
    ("near_dedup", near_duplicates),
    ("pii", personal_data),
    ("packing", pack),
]

#: SQL can't express the classifier, the curve or the tokens; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs)
    return docs
