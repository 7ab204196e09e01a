"""A corpus pipeline over ``documents``: each stage is one operator of
``orrery.llm``, works on all rows its predecessor kept and hands on the columns
of ``documents``; the last returns packed sequences.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import langid, minhash, packing, quotient, secrets
from orrery.llm.util import documents, short_batches
from orrery.session import remove_at_end, scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what language ID rejects: unknown texts and narrow margins."""
    short_batches(spark)
    return langid.keep_known(docs, langid.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return quotient.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five words, similarity 0.8."""
    short_batches(spark)
    return minhash.drop_near(docs, shingle=5, percent=80)


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; a mark stands for every secret, and n_chars follows the text."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    short_batches(spark)
    return packing.pack(docs, packing.load(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("language", language), ("exact", exact), ("near", near), ("secrets", secret), ("packing", packed)]

#: No stage of these has an SQL form; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each result written as Parquet under the shared
    checkpoint folder and read again as the next one's input; the folder goes
    when the application ends."""
    docs = documents(spark, sf_dir)
    home = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    remove_at_end(spark, home)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
