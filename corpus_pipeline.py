"""A training corpus from the documents table, in stages that are each written before the next one reads."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderrisk.llm import decontaminate, jaccard, packing, quality, repeats
from orderrisk.session import cut_lineage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    Null and empty texts have a score like others, repeated rows share it, columns of any name come through, and an empty
    table stays empty.
    """
    measured = cut_lineage(quality.statistics(docs))
    model = quality.fit(measured, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model)


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column has them."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest doc_id, then the smallest hash of its text.

    Rows are judged, not doc_ids: rows that share a doc_id and are in different groups all stay. Rows without
    words are in no group and stay, and so do rows without a doc_id. Of rows that repeat doc_id and text the one
    with the smallest other columns stays. Rows are told apart by a 64-bit hash of doc_id and text. Columns of any name come
    through, and an empty table stays empty.
    """
    row, twice = _free(docs, "_row", "_again")
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    rows = keyed.where("doc_id is not null").groupBy(row).agg(F.min("doc_id").alias("doc_id"), F.min(F.xxhash64("text")).alias("hash"), F.count("*").alias("n"))
    found = jaccard.join(keyed, key=row).where("n_shingles > 0").select(row, "component_id").distinct()
    judged = cut_lineage(found.join(rows, row))
    first = judged.groupBy("component_id").agg(F.min(F.struct("doc_id", "hash", row)).alias("first")).select(F.col("first")[row].alias(row))
    gone = judged.select(row).join(first, row, "left_anti")
    again = judged.where("n > 1").select(row, F.lit(True).alias(twice))
    left = keyed.join(gone, row, "left_anti").join(again, row, "left")
    repeated = left.where(F.col(twice)).groupBy(row).agg(F.min(F.struct(*docs.columns)).alias("kept")).select("kept.*")
    return left.where(F.col(twice).isNull()).select(docs.columns).unionByName(repeated)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the byte strings that occur earlier; n_chars follows the text. Nulls become empty."""
    carried = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    found = repeats.repeats(docs, with_text=True, carried=carried)
    found = found.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), *(F.col("carried")[c].alias(c) for c in carried))
    return found.select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark text.

    Null and empty texts stay, rows are judged by doc_id and text, so repeated rows go or stay together, and columns of any
    name come through. An empty table or benchmark changes nothing.
    """
    (key,) = _free(docs, "_key")
    keyed = docs.withColumn(key, F.struct(F.coalesce("doc_id", F.lit(-1)).alias("id"), F.xxhash64("text").alias("text")))
    found = decontaminate.decontaminate(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key=key)
    return keyed.join(found.where("contaminated").select(key).distinct(), key, "left_anti").select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence.

    A null or empty text is one piece of one id, repeated rows have places of their own, other columns are left out
    and an empty table has no pieces.
    """
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeat_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: The classifier, the tokenizer and the packing plan have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
