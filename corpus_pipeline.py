"""The corpus pipeline: STAGES applied in order, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but
the last return the columns of ``documents``, whatever other columns these hold.

Defined results: a null or empty text goes in the first stage (it has too few words); rows
without an id, or with one that repeats, are judged by their texts like any others; of rows
equal in id and text one stays; very long texts pass whole; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import decontam, mixing, near_dup, packing, quality_rules
from paylake.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    led = quality_rules.apply_policy(quality_rules.ledger(docs.select(F.struct(*docs.columns).alias("row"), "text")))
    return led.filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest doc_id (null before all); repeated rows are one."""
    return near_dup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages by the contamination rule."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mix), ("token packing", tokens)]
#: SQL cannot tokenize and pack; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between them the rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{k}")
    return docs
