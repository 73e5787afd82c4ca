"""The corpus pipeline: quality, exact and near duplicates, benchmark passages, mix.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept.  All but the last return the columns of ``documents``; the last adds size,
source_size, target and taken, and keeps the documents that the mix reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corate.llm.common import keyed_rows, table
from corate.llm.decontaminate import decontaminate
from corate.llm.exact import exact_dedup
from corate.llm.mixing import mixed_documents
from corate.llm.near import near_dedup
from corate.llm.queries import quality_scores
from corate.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality_scores(docs, sf_dir).where("predicted = 1").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, also of rows that repeat an id or have none."""
    rows, key = keyed_rows(docs, "doc_id")
    return near_dedup(rows, key).select(*docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, and how many of their words it takes."""
    return mixed_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("benchmark decontamination", clean),
    ("source mixing", mix),
]
# A learned score has no SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
