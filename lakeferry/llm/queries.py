"""The registered queries of the numbered operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    ann,
    katz,
    langid,
    minhash,
    mixing,
    packing,
    periodic,
    pii,
    quality,
    secrets,
    sharding,
    urls,
    whitening,
)
from .common import read


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), k=2, similarity_pct=80)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(read(spark, sf_dir, "documents"), n_shards=40)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.evaluate(spark, sf_dir)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(read(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.evaluate(read(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.evaluate(read(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.evaluate(read(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.evaluate(read(spark, sf_dir, "embeddings"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.evaluate(read(spark, sf_dir, "documents"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.evaluate(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_minhash_dedup": op1,
    "op2_byte_shards": op2,
    "op3_nearest_vectors": op3,
    "op4_url_filters": op4,
    "op5_quality_rules": op5,
    "op6_katz_scores": op6,
    "op7_source_mixing": op7,
    "op8_language_id": op8,
    "op9_secret_scans": op9,
    "op10_sequence_packing": op10,
    "op11_embedding_whitening": op11,
    "op12_periodic_runs": op12,
    "op13_personal_data": op13,
}
ORACLES: dict[str, str] = {
    "op4_url_filters": urls.ORACLE,
    "op5_quality_rules": quality.ORACLE,
    "op7_source_mixing": mixing.oracle(),
}
