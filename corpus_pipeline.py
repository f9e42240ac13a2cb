"""The corpus pipeline: documents in, packed token sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm import cost_packing, decontam, line_dedup, simhash, tokens, toxicity
from casegrid.llm.common import small_batches, table
from casegrid.session import materialise

WORD_FILE = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    small_batches(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), only=lambda i: ~toxicity.held_out(i))
    return toxicity.drop_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of two lines or more go; the document stays with what is left."""
    small_batches(spark)
    return line_dedup.drop_repeated_lines(docs, every_line=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    small_batches(spark)
    return simhash.near_dedup(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    small_batches(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of balanced cost, one row per piece."""
    small_batches(spark)
    pieces = cost_packing.cost_packed(docs, tokens.WordIds(public_tokenizers.path(WORD_FILE)))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("packing", pack),
]

#: Learned scores, rolling hashes and token ids have no SQL form; the pipeline
#: is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
