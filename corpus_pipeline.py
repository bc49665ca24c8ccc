"""The corpus pipeline: five filtering and packing stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
keep the columns of ``documents``. ``run`` writes each stage's rows below the
shared folder and gives them to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wareflow.llm import decontaminate, exact_dedup, jaccard_join, packing, toxicity
from wareflow.llm.common import documents, kept, ship
from wareflow.session import configure

#: Alignment, regression and packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject."""
    ship(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text."""
    ship(spark)
    return exact_dedup.survivors(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship(spark)
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    ship(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, packed into sequences."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_duplicates", near_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    sf_dir = sf_dir.rstrip("/")
    configure(ship(spark))
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
