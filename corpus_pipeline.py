"""A corpus pipeline over documents: quality rules, near duplicates, benchmark decontamination, personal
data, and mixing to target weights. Each stage works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sugarloom.llm.common import staged, table
from sugarloom.llm.decontaminate import clean
from sugarloom.llm.mixing import mix
from sugarloom.llm.ngram_join import first_of_components
from sugarloom.llm.pii import find_pii
from sugarloom.llm.quality import quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the counts and the divergence from their language.

    Null and empty texts have no words and go; a null lang is a language of its own; rows of null or equal ids, and
    repeated rows, are judged each; other columns than those of documents are left out. No rows give no rows.
    """
    return quality(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the first row by doc_id, nulls last, and text; unlike texts of one id all stay.

    Rows of equal id and text are one; texts without words are linked with nothing. No rows give no rows.
    """
    return first_of_components(docs.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of the benchmark, each row judged by its own text.

    Null and empty texts stay, as do rows of null or repeated ids; either table may be empty.
    """
    return clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind; n_chars is that of the new text.

    A null text stays null, with a null n_chars; every row stays, repeated ones too.
    """
    found = find_pii(docs.select(*COLUMNS))
    return found.withColumn("text", F.col("redacted")).withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long"))).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each document how many of its words the mix takes.

    A null source is a source of its own; null texts have size 0; a row without doc_id is placed by its text.
    """
    return mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("mixing sources to target weights", mixing),
]

#: The divergence, the model of personal data and edit distances are no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.split()[0])
    return docs
