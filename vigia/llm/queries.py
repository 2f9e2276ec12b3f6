"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, decontaminate, embeddings, hard_negatives, html_text, langid, licenses, oracle, order_minhash, packing,
               periodic, quality, simhash, substring)
from .rows import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"),
                       tokenizer_pattern())


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(table(spark, sf_dir, "documents"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.passages(table(spark, sf_dir, "documents"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.report(table(spark, sf_dir, "embeddings"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_bpe": op1_bpe, "op2_simhash": op2_simhash, "op3_licenses": op3_licenses, "op4_html": op4_html, "op5_passages": op5_passages, "op6_embeddings": op6_embeddings, "op7_quality": op7_quality, "op8_order_minhash": op8_order_minhash, "op9_packing": op9_packing, "op10_langid": op10_langid, "op11_periodic": op11_periodic, "op12_hard_negatives": op12_hard_negatives, "op13_decontaminate": op13_decontaminate}


def oracle_sql() -> dict[str, str]:
    return {"op3_licenses": oracle.licenses_sql(), "op6_embeddings": oracle.EMBEDDINGS, "op12_hard_negatives": oracle.HARD_NEGATIVES, "op13_decontaminate": oracle.DECONTAMINATION}
