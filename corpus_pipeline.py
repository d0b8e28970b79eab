"""From raw documents to packed training windows: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.common import outlives, stored, temporary_tables
from plumbline.llm.exact_dedup import without_duplicates
from plumbline.llm.language_id import fit, held_out, with_predicted_language
from plumbline.llm.mixing import mixed_documents
from plumbline.llm.near_dedup import without_near_duplicates
from plumbline.llm.packing import pack
from plumbline.llm.queries import mixture, tokenizer_path

# Documents without a letter are rejected, and those whose language is told with no more than this share of the way
# from chance to certainty. Texts of one language score far above, texts of two about half way.
LEAST_CONFIDENCE = 0.07
# The mixture takes as many tokens as there are, so that sources below their share are repeated.
MIX_FRACTION = 1.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network tells, with that language as their ``lang``: the later stages go by it.

    Texts that are null, empty or without a letter go; very long ones are read
    whole. Repeated rows all stay. Columns may have any name.
    """
    return with_predicted_language(docs, fit(docs, ~held_out()), LEAST_CONFIDENCE)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the row with the smallest ``doc_id``; of repeated rows, one.

    Null counts as empty, a null ``doc_id`` comes after all others. Columns may have any name.
    """
    return without_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that near ones connect, the row with the smallest ``doc_id``; of repeated rows, one.

    Null, empty and white texts are one class. A null ``doc_id`` comes after all others. Columns may have any name.
    """
    return without_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mixture of domains, (predicted) languages and sources; some go, some come several times.

    Null keys are leaves of their own; texts without words count no tokens.
    Repeated rows are taken as often as all of them are selected. Columns may have any name.
    """
    return mixed_documents(docs, mixture(), fraction=MIX_FRACTION)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of training windows (:func:`plumbline.llm.packing.pack`), null texts as their end id."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Neither the network nor the tokenizer can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; each result is stored before the next stage reads it.

    A stage's own tables, and the result it read, are deleted when its result
    is stored, or when it fails. The result that the last stage reads lives as
    long as a surrounding :func:`plumbline.llm.common.temporary_tables`, or else
    as the driver's process. An empty table gives no rows in any stage.
    """
    docs, copy = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with temporary_tables(spark) as tables:
            if copy is not None:
                tables.append(copy)
            docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
            copy = tables.pop()
    outlives(copy)
    return STAGES[-1][1](spark, docs, sf_dir)
