"""A corpus pipeline over ``documents``: each stage calls one operator.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept and is written as Parquet in the cluster's shared folder before the next
one reads it, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keyfold.llm import op1_tiling, op3_quality, op6_mix, op7_pack, op9_simhash
from keyfold.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return op3_quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return op9_simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return op1_tiling.drop_leaks(docs, table(spark, sf_dir, "benchmark"), short=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return op6_mix.mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed id matrix."""
    return op7_pack.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing),
    ("token packing", packing),
]

#: Tiling, link components and packing are outside SQL; the stages are tested
#: against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
