"""The corpus pipeline: language ID, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and reread as the next stage's docs. All but the last return the columns of ``documents``;
the last adds ``copies``, the number of times the mix holds a document.

Defined results: a null or empty text, or one without letters, is rejected by the first stage,
unless no row has a language to learn from: then all rows stay there. Repeated rows, copies and ties are
settled by the operators (see their docstrings). Very long texts are used whole. An empty table gives an
empty mix. Further columns pass through under their own names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callcorpus.llm import common, decontaminate, langid, line_dedup, mixing, near_dedup


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected (operator 5)."""
    return langid.keep_identified(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that an earlier document holds (operator 4)."""
    return line_dedup.drop_repeated(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 6)."""
    return near_dedup.keep_first(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark`` (operator 7)."""
    return decontaminate.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with their number of copies (operator 2)."""
    return mixing.mix_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix),
]

#: Language ID and BagMinHash are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and reread."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
