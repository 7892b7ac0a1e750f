"""K1 as an incremental job: land new raw files as Parquet with Structured
Streaming's file source.

The reference lands raw files in one batch.  On a cluster the same landing runs
as ``trigger(availableNow=True)``: only files not yet seen are read, and the
checkpoint (in the shared checkpoint folder) records progress.  Each micro-batch
is one write into the folder of its batch id, good and malformed records beside
each other, so a batch that is replayed after a crash replaces itself and changes
nothing.  No other streaming semantics exist in the pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import BROKEN, CORRUPT, GOOD, STATE

BATCH = "batch_id"


def write_batch(batch: DataFrame, batch_id: int, target: str) -> None:
    """The records of one micro-batch; the same id replaces its own folder."""
    state = F.when(F.col(CORRUPT).isNotNull(), F.lit(BROKEN)).otherwise(F.lit(GOOD))
    batch.withColumn(STATE, state).write.mode("overwrite").partitionBy(STATE).parquet(f"{target}/{BATCH}={batch_id}")


def land_incremental(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str,
                     target: str, checkpoint: str, max_files_per_trigger: int | None = None) -> None:
    """Process every file present under ``source_dir`` that earlier runs have
    not landed."""
    reader = (spark.readStream.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
              .option("columnNameOfCorruptRecord", CORRUPT).format("json" if fmt == "jsonl" else fmt))
    if fmt == "csv":
        reader = reader.option("header", True)
    if fmt == "json":
        reader = reader.option("multiLine", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (reader.load(source_dir).writeStream.foreachBatch(lambda batch, i: write_batch(batch, i, target))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def _landed(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    added = [(CORRUPT, T.StringType()), (BATCH, T.LongType()), (STATE, T.StringType())]
    return spark.read.schema(T.StructType([*schema.fields, *(T.StructField(c, t) for c, t in added)])).parquet(target)


def read_landed(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The good records of all batches."""
    return _landed(spark, target, schema).filter(F.col(STATE) == GOOD).select(*schema.fieldNames())


def read_malformed(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """(batch_id, raw text) of the records that could not be read."""
    return _landed(spark, target, schema).filter(F.col(STATE) == BROKEN).select(BATCH, CORRUPT)
