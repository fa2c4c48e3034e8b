"""From raw documents to packed training sequences.

Five stages, each a function of (spark, docs, sf_dir) that calls one operator of
``millrace.llm``. Every stage works on all rows its predecessor kept; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.chunk_dedup import drop_copies
from millrace.llm.host_rules import keep_good
from millrace.llm.packing import pack_documents
from millrace.llm.shared import scratch
from millrace.llm.source_mix import mixed_rows
from millrace.llm.token_ids import tokenizer_file
from millrace.llm.token_groups import Similarity, drop_near_copies
from millrace.session import ensure_checkpoint_dir, tune
from millrace.sinks.folders import Folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the verdict on their host keep."""
    return keep_good(docs, "text", "source")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingles of five words, at 0.8 or more, the one with the smallest id."""
    return drop_near_copies(docs, Similarity(n=5, num=8, den=10))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 1024 tokens."""
    return pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Tokenizing and local search have no SQL form; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next.

    The tables that a stage makes on its way are deleted when its own is whole,
    and a stage's table when the next one is; those of the last stage stay, as
    its result is made when it is read.
    """
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    folder, before = Folder(spark, ensure_checkpoint_dir(spark)), None
    for name, stage in STAGES[:-1]:
        table = f"pipeline-{name}-{uuid.uuid4().hex}"
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(f"{folder.path}/{table}")
        docs = spark.read.schema(out.schema).parquet(f"{folder.path}/{table}")
        if before:
            folder.delete(before)
        before = table
    return STAGES[-1][1](spark, docs, sf_dir)
