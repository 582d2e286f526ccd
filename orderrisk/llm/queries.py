"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderrisk.session import scratch_dir

from . import codes, counts, dac, decontaminate, html_text, jaccard, lexical, licenses, minhash, neighbours, packing, quality, repeats

from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(_table(spark, sf_dir, "documents")).drop("removed")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_table(spark, sf_dir, "documents"), null_is_least=False)


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op5_binary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_dir(spark)}/ids-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    files = dac.write(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return dac.read(files, folder).drop("ids")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.coded(_table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_license_scan": op4_license_scan,
    "op5_binary_ids": op5_binary_ids,
    "op6_html_text": op6_html_text,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_decontamination": op9_decontamination,
    "op10_token_counts": op10_token_counts,
    "op11_vector_codes": op11_vector_codes,
    "op12_lexical_search": op12_lexical_search,
    "op13_minhash_dedup": op13_minhash_dedup,
}
