"""From raw documents to packed training sequences, stage by stage.

Every stage works on all rows that its predecessor kept and returns the columns of ``documents``; the last one returns
packed pieces. Null and empty texts are rejected by language identification, since they have no language.
Rows with a null id, or an id that repeats, are judged by their own text; extra columns are carried along. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabkit.llm import decontamination, language_id, near_dedup, quality, vector_packing
from tabkit.llm.common import store, table
from tabkit.llm.queries import TOKENIZER

#: A text whose predicted language is less likely than this is rejected. With two families of two languages the scores cannot fall
#: below it; it takes effect with more languages.
LEAST_LANGUAGE = 0.25
#: A text whose n-grams are so many standard deviations from the learned languages is rejected; clean texts stay under 3.
FAR_FROM_LANGUAGE = 4.0

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: texts without a letter, or of no learned language, go."""
    return language_id.identify_languages(docs, language_id.fit_language_model(docs), least=LEAST_LANGUAGE, far=FAR_FROM_LANGUAGE)


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each class of near duplicates the document with the least id stays."""
    return near_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents with a benchmark item go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: what is left is tokenized and packed."""
    return vector_packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify),
    ("quality", judge),
    ("near_dedup", deduplicate),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Classifiers and hash signatures have no SQL form; tests/llm compares the run with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
