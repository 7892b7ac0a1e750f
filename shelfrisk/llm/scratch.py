"""Intermediate tables of the operators, in the shared folder the session names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

BATCH_BYTES = 4 << 20        # of a batch that a task passes to Python (a longer row is a batch of its own)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table.  Batches are bounded by bytes too: a number of rows says
    little of the memory that whole texts take."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage
    ends at files every executor sees, so a lost executor costs its own tasks only."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened by underscores until ``df`` has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
