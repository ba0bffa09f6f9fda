"""Registered queries of the training-data operators, over whole tables, and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadflow.llm import bpe, codebooks, decontaminate, lloyd, minhash, mixing, pii, secret_scan, substrings, topk, toxicity, winnow, wrapper
from leadflow.llm.common import read_table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.op1_query(read_table(spark, sf_dir, "documents"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.op2_query(read_table(spark, sf_dir, "pages"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.op3_query(read_table(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.op4_query(read_table(spark, sf_dir, "embeddings"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.op5_query(read_table(spark, sf_dir, "documents"), substrings.WORDS)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.op6_query(read_table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op7_query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op8_query(read_table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op9_query(read_table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op10_query(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op11_query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.op12_query(read_table(spark, sf_dir, "embeddings"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.op13_query(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1,
    "op2_html": op2,
    "op3_fingerprints": op3,
    "op4_topk": op4,
    "op5_substrings": op5,
    "op6_secrets": op6,
    "op7_toxicity": op7,
    "op8_pii": op8,
    "op9_mixing": op9,
    "op10_bpe": op10,
    "op11_decontaminate": op11,
    "op12_lloyd": op12,
    "op13_codebooks": op13,
}
ORACLES: dict[str, str] = {"op4_topk": topk.OP4_SQL, "op11_decontaminate": decontaminate.OP11_SQL, "op12_lloyd": lloyd.OP12_SQL, "op13_codebooks": codebooks.OP13_SQL}
