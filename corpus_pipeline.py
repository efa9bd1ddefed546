"""A corpus from documents to packed sequences: toxic documents go, repeated lines go, one document of each group of near
copies stays, documents with benchmark passages go, and the rest is packed.

Every stage takes (spark, docs, sf_dir), works on all rows of its predecessor and, but for the last, returns the columns
of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm import decontam, line_dedup, packing, simhash, toxicity
from leadlens.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the model (fitted on labelled rows of ``docs``) doesn't reject; a null text counts as empty, equal rows go or stay alike,
    an empty table stays empty.  Other columns pass."""
    return toxicity.drop_toxic(docs, toxicity.fit_on(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay, without the lines that match an earlier one; n_chars follows the text.  A null text stays null; rows equal in id and
    text are one document; an empty table stays empty."""
    out = line_dedup.dedup_lines(docs).select(docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row of smallest id (null ids last).  Null texts and those without words have one fingerprint, so that
    one of them stays; an empty table stays empty."""
    return simhash.keep_one_of_each(docs, shingle=3, max_distance=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark; null and empty texts stay, as do all with an empty benchmark; equal rows go or stay alike."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a null text is empty and still has its end id, repeated rows are packed each, an empty table
    gives no piece."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), remember=200_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The stages hold a trained model and a packing heuristic, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
