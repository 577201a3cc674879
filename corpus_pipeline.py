"""From raw documents to packed training sequences.

Each stage calls one operator, works on all that the stage before has kept, and is written as Parquet in the shared
work folder and read again, so a lost executor never reaches back beyond one stage. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cloakframe.llm import crf_language, decontaminate, packing, quality_rules, simhash
from cloakframe.llm.common import stored
from cloakframe.llm.queries import word_length
from cloakframe.sources.tables import load_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.keep_clean(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, those without a letter, go."""
    return crf_language.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays."""
    return simhash.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a benchmark covers a twentieth or more go."""
    return decontaminate.keep_uncontaminated(docs, load_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a training sequence."""
    return packing.best_fit(docs, word_length())


STAGES = [
    ("quality_rules", quality),
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("best_fit_packing", pack),
]

# SQL has neither a conditional random field nor the fingerprints' hash; a test holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
