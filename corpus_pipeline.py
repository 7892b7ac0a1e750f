"""The corpus pipeline: quality, near-duplicates, decontamination, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents.  All but the last
return the columns of ``documents``.  Null and empty texts pass the classifier
by its bias, are no near-duplicates, are never contaminated, and give the mix
nothing; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrisk.llm import decontaminate, mixing, near_dup, packing, quality
from shelfrisk.llm.scratch import stored, table, unused


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    name = unused(docs, "__score")[0]
    scored = quality.score(docs, weights, tuple(docs.columns), "text", name)
    return scored.where(F.col(name) >= quality.ACCEPT).drop(name)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dup.keep_one(docs, near_dup.near_duplicates(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources as documents, cut to the words that it takes."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the packed id matrix."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicates", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Trained weights, sketches, seeded draws and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
