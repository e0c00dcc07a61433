"""From raw documents to packed sequences: five stages, each written as Parquet and read again.

Columns of the documents stay as they are up to the last stage, which returns the packed pieces. Each
stage judges what the one before has kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import queries
from sensorloom.llm.exact_dedup import exact_dedup
from sensorloom.llm.language import identify
from sensorloom.llm.packing import pack_documents, send_definition
from sensorloom.llm.simhash import keep_one
from sensorloom.llm.substring import remove_repeats
from sensorloom.session import shared_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or of ambiguous language go."""
    found = identify(docs, queries.language_model(docs))
    return found.where("lang_pred != 'und' and not ambiguous").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup(docs).where("kept").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near-equal fingerprints the one with the smallest id stays, one row of each group."""
    return keep_one(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that a document with a smaller id has, too, go; a document left without words goes with them."""
    done = remove_repeats(docs).where("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")).alias("text")
    count = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("n_chars")).cast("long").alias("n_chars")
    return done.select(*(text if c == "text" else count if c == "n_chars" else F.col(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenized pieces with their places in sequences of 2,048 tokens."""
    packed = pack_documents(docs.select("doc_id", "text"), send_definition(spark, queries.vocabulary_path()))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("substring_dedup", substrings),
    ("packing", packing),
]

#: Language models, fingerprints and packing can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what each keeps is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
