"""Sinks and typed tables (K1-K4, K6).  Every write is a distributed Spark write.
An overwrite removes the old files before the new ones are committed, so a job
that fails leaves neither; where readers must never see that, use ``reload`` (K5)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import FACT_COLUMNS
from ..schemas import FACT_STOCK_RISK, RUN_LOG, WAREHOUSE


def land(frames: dict[str, DataFrame], root: str, fmt: str = "parquet",
         partition_by: dict[str, Sequence[str]] | None = None) -> dict[str, str]:
    """K1: land every source as-is (one write per dataset)."""
    paths = {}
    for name, df in frames.items():
        if df is None:
            continue
        path = f"{root.rstrip('/')}/{name}"
        w = df.write.mode("overwrite").format(fmt)
        cols = (partition_by or {}).get(name)
        if cols:
            w = w.partitionBy(*cols)
        w.save(path)
        paths[name] = path
    return paths


def write_fact(fact: DataFrame, path: str, partition_by: str | None = None) -> str:
    """K2: fact table as Parquet, optionally partitioned (e.g. by region); rows
    are then rebalanced by that column, so a value gets few, well-sized files."""
    if partition_by:
        fact.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        fact.write.mode("overwrite").parquet(path)
    return path


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The written fact with its types and column order.  (An empty string in a
    partition column comes back as NULL: a partition has no other name for it.)"""
    return spark.read.schema(FACT_STOCK_RISK).parquet(path).select(*FACT_COLUMNS)


def write_quality(report: DataFrame, path: str) -> str:
    """K3: the quality report is a few rows; one file."""
    report.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def run_record(df: DataFrame, step: str, metric: str = "rows_written",
               run_id: str | None = None) -> DataFrame:
    """K4 record computed as an aggregate of the written table."""
    run_id = run_id or uuid.uuid4().hex
    return df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit(run_id).alias("run_id"), F.lit(step).alias("step"), F.lit(metric).alias("metric"),
        "value")


def write_run_log(records: DataFrame, path: str) -> str:
    """K4: put (run_id, step, metric, value) records into the run-log table.  The
    log is partitioned by run and step and only the partitions written are
    replaced, so a retried run replaces its own records and no others."""
    (records.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id", "step").parquet(path))
    return path


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path).select(*RUN_LOG.fieldNames())


def append_run_log(spark: SparkSession, df: DataFrame, path: str, step: str,
                   metric: str = "rows_written", run_id: str | None = None) -> DataFrame:
    """K4: put the record of one run into the run log; returns the record."""
    rec = run_record(df, step, metric, run_id)
    write_run_log(rec, path)
    return rec


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_tables(spark: SparkSession, root: str, prefix: str = "", names: Sequence[str] | None = None,
                  paths: dict[str, str] | None = None) -> list[str]:
    """K6: CREATE TABLE IF NOT EXISTS for the warehouse tables, typed from
    the same StructTypes the jobs use, over ``paths`` (the current version of a
    reload) or ``root/<table>``; a table that exists is pointed there.  Keys are
    enforced by E4 / J7 jobs."""
    created = []
    for name in names or WAREHOUSE:
        schema = WAREHOUSE[name][0]
        table, location = f"{prefix}{name}", (paths or {}).get(name, f"{root.rstrip('/')}/{name}")
        known = spark.catalog.tableExists(table)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_ddl(schema)}) USING parquet LOCATION '{location}'")
        if known:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            spark.catalog.refreshTable(table)
        created.append(table)
    return created


def drop_tables(spark: SparkSession, tables: Sequence[str]) -> None:
    """Forget the tables; their files stay."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
