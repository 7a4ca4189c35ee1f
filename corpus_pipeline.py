"""A tokenised corpus from raw documents: five stages, each on all that the one before has kept.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``docs``.
Null, empty and very long texts, repeated rows, empty tables and extra columns are treated as
the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopledger.llm import decontamination, langid, pieces, pii, queries, simhash
from shopledger.llm.common import stored

# Below this probability no learned language fits a text, if four are learned; short texts of a known one lie above.
MIN_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language learned from the labelled rows, go."""
    model = langid.train(langid.labelled_part(docs))
    return langid.identified(docs, model, langid.least_score(MIN_LANGUAGE_SCORE, len(model.languages)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; all documents stay."""
    return pii.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, long ones in parts."""
    return pieces.encode(docs, pieces.load(queries.public_model()))


STAGES = [
    ("language identification", identify_language),
    ("simhash near duplicates", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("personal data", redact_personal_data),
    ("sentencepiece encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# The rows hold trained predictions and token ids, which SQL cannot express.
ORACLE_SQL = None
