"""From raw documents to packed token sequences: five stages, each written as Parquet and read again.

A stage is a function of (session, documents, folder of the tables). All but the
last return the columns of ``documents``; n_chars follows the text. A stage
judges what its predecessor kept, and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitalgrid.llm.line_dedup import dedup_lines
from vitalgrid.llm.near_dedup import drop_near_copies
from vitalgrid.llm.packing import pack_documents
from vitalgrid.llm.quality import judge, train
from vitalgrid.llm.queries import SURROGATE_KEY, vocabulary
from vitalgrid.llm.surrogates import replace_entities
from vitalgrid.session import scratch, shared_folder, tune

#: Near copies are compared by shingles of five words.
SHINGLE = 5


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, n_chars counted anew."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    return docs.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the line labels reject go."""
    field = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, field).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents or more hold stay in the one with the largest id."""
    return _measured(dedup_lines(docs), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row of the document with the smallest id stays."""
    return drop_near_copies(docs, width=SHINGLE)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to surrogates."""
    return _measured(replace_entities(docs, SURROGATE_KEY), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as token pieces in sequences: a row per piece."""
    return pack_documents(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("pii_surrogates", pii_surrogates),
    ("best_fit_packing", best_fit_packing),
]

#: Trained labels, signatures and tokens can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = shared_folder(tune(spark))
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        with scratch(spark):  # what a stage has stored on its way
            stage(spark, docs, sf_dir.rstrip("/")).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
