"""The catalogue's queries over the text operators, with production parameters on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardflow.llm.common import documents
from hazardflow.llm.exact_dedup import exact_dedup
from hazardflow.llm.langid import predict
from hazardflow.llm.line_dedup import line_components
from hazardflow.llm.lm_score import lm_score
from hazardflow.llm.merkle import tamper_check
from hazardflow.llm.mixing import mix_plan
from hazardflow.llm.near_dedup import near_dedup
from hazardflow.llm.neighbours import nearest
from hazardflow.llm.periodic_runs import periodic_runs, run_digests, with_planted_period
from hazardflow.llm.quality import quality
from hazardflow.llm.secrets import find_secrets, fit_models, scan_digests
from hazardflow.llm.sentencepiece_codec import encode
from hazardflow.llm.substring_dedup import substring_dedup


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))


def op2_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_components(documents(spark, sf_dir))


def op4_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), "source", "copies"
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(documents(spark, sf_dir))


def op6_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(documents(spark, sf_dir))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(documents(spark, sf_dir).select("doc_id", "text"), check_column="round_trip")
    return coded.select("doc_id", "ids", F.size("ids").alias("n_pieces"), "round_trip")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir), keep="largest")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir), width=4)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tamper_check(documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_planted_period(documents(spark, sf_dir))))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scan_digests(find_secrets(docs, fit_models(docs)))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_compression_quality": op2_compression_quality,
    "op3_line_dedup": op3_line_dedup,
    "op4_pareto_mixing": op4_pareto_mixing,
    "op5_language_id": op5_language_id,
    "op6_lattice_score": op6_lattice_score,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_nearest": op9_nearest,
    "op10_near_dedup": op10_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_secret_scan": op13_secret_scan,
}
