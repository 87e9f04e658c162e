"""From raw documents to packed training sequences, in five stages.

Each stage works on all that the stage before kept; its input is read from Parquet and its
result written as Parquet. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.llm import langid, minhash, mixing, packing, secrets
from lakeferry.llm.common import Scratch, read, small_batches

#: Mild damping: most documents of the most frequent values stay.
MIX_TARGETS = {"source": 0.95, "lang": 0.95, "topic": 1.0}


#: Bytes of an Arrow batch: the stages share their Python workers, whose memory stays.
BATCH_BYTES = 4 << 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from ``docs``. Null, empty and letterless
    texts go, and those that no language explains: of whose n-grams the winner has less
    than half the share that it has of the median of its own texts."""
    small_batches(spark, BATCH_BYTES)
    model = langid.fit(docs)
    known = langid.predict(docs.select(F.struct("*").alias("doc")), model, "doc")
    return known.where(langid.explained(model)).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    small_batches(spark, BATCH_BYTES)
    return minhash.dedup(docs, k=5, similarity_pct=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    small_batches(spark, BATCH_BYTES)
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights of sources, languages and topics."""
    return mixing.mix(docs, MIX_TARGETS)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    small_batches(spark, BATCH_BYTES)
    return packing.evaluate(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: Bloom filters, minima, automata and column generation are beyond SQL; tests/llm holds
#: each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark), read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
