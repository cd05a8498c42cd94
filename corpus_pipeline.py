"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokenisation.

Each stage takes all that its predecessor kept, in the columns of ``documents``; the last returns ids and
digests. The stages before it only drop documents, but for line dedup, which shortens texts.

Defined cases are those of the operators: a null or empty text fails the quality rules (too few words); a text whose lines all go in line dedup stays as
an empty one, and empty texts are one class of near-duplicates; rows that repeat a document are judged alike; columns beyond those of
``documents`` pass to the last stage; an empty table, or an empty benchmark, goes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.llm import line_chunks, near_dup, quality_rules, sentencepiece_bpe, template_decontam
from postwave.llm.common import stored
from postwave.llm.queries import model_path, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return quality_rules.filter_stage(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of repeated chunks; ``n_chars`` follows the text."""
    return line_chunks.dedup_stage(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dup.keep_stage(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return template_decontam.clean_stage(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the ids, and digest of the decoded text, of every document left."""
    return sentencepiece_bpe.encode_decode(docs, model_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_chunks", lines),
    ("near_dup", near_duplicates),
    ("template_decontamination", decontaminate),
    ("sentencepiece", tokens),
]

#: Compression ratios, signatures and merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
