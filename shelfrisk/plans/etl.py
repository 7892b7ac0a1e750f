"""D3: the whole ETL run as Spark jobs.

extract (S1-S4) -> clean (CL1-CL6) -> quality report (E1 + U1)
               -> fact (D2) -> final check (E2) -> write (K2, K3) -> run log (K4)

The cleaned layer is written once to the shared scratch folder and read
back, so the quality report and the fact table start from the same files
(no recomputation, lineage cut, survives executor loss).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from .. import params as P
from ..operators import clean as C
from ..operators.aggregate import month_of
from ..operators.duplicates import dedupe_exact_by_hash
from ..operators.quality import final_table_check, quality_report
from ..session import scratch_path, tune
from ..sources.files import SourceSpec, read_sources
from ..sources.sinks import append_run_log, read_fact, read_run_log, write_fact, write_quality
from .fact import build_fact_stock_risk


def clean_sources(frames: dict[str, DataFrame],
                  date_formats: Sequence[str] = (P.ISO_DATE,),
                  valid_event_types: Sequence[str] = P.VALID_EVENT_TYPES,
                  dedupe: Callable[[DataFrame], DataFrame] = C.dedupe_exact) -> dict[str, DataFrame]:
    """CL1-CL6 over the six sources (dates are parsed in UTC, see ``tune``)."""
    tune(frames["orders"].sparkSession)
    return {
        "orders": C.clean_orders(frames["orders"], date_formats, dedupe),
        "products": C.clean_products(frames["products"]),
        "stores": C.clean_stores(frames["stores"], date_formats),
        "inventory": C.clean_inventory(frames["inventory"]),
        "reviews": C.clean_reviews(frames["reviews"], date_formats),
        "events": C.clean_events(frames["events"], valid_event_types),
    }


def fact_from_clean(cleaned: dict[str, DataFrame], **kw) -> DataFrame:
    return build_fact_stock_risk(cleaned["orders"], cleaned["products"], cleaned["stores"],
                                 cleaned["inventory"], cleaned["reviews"], cleaned["events"], **kw)


def materialize(spark: SparkSession, frames: dict[str, DataFrame], name: str,
                time_partitions: dict[str, tuple[str, str]] | None = None) -> dict[str, DataFrame]:
    """Write each frame as Parquet under the shared scratch folder and read it
    back: a lineage cut that a lost executor cannot undo.  Time-series tables
    are partitioned by month (``time_partitions``), so trailing windows read
    only their last partitions; the rebalance hint lets AQE give each month
    few, well-sized files and split a hot month over several tasks."""
    parts = P.TIME_PARTITIONS if time_partitions is None else time_partitions
    root = scratch_path(spark, name)
    out = {}
    for key, df in frames.items():
        path = f"{root}/{key}"
        if key in parts:
            col, ts = parts[key]
            (df.withColumn(col, month_of(ts)).hint("rebalance", col)
               .write.mode("overwrite").partitionBy(col).parquet(path))
        else:
            df.write.mode("overwrite").parquet(path)
        out[key] = spark.read.parquet(path)
    return out


def without_time_partitions(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {k: df.drop(*[c for c, _ in P.TIME_PARTITIONS.values()]) for k, df in frames.items()}


def run_etl(spark: SparkSession, frames: dict[str, DataFrame], output_root: str,
            date_formats: Sequence[str] = (P.ISO_DATE,),
            valid_event_types: Sequence[str] = P.VALID_EVENT_TYPES,
            partition_fact_by: str | None = None, run_id: str | None = None) -> dict[str, DataFrame]:
    """D3 from ready frames; a run that is retried under its ``run_id`` replaces
    its record in the log.  Returns the outputs re-read from ``output_root``:
    the fact, the quality report, the final check (E2) and the run log."""
    tune(spark)
    cleaned = materialize(spark, clean_sources(frames, date_formats, valid_event_types, dedupe_exact_by_hash), "clean")
    quality = quality_report(without_time_partitions(cleaned))
    fact_path = write_fact(fact_from_clean(cleaned), f"{output_root}/fact_stock_risk", partition_fact_by)
    quality_path = write_quality(quality, f"{output_root}/quality_checks")
    fact_back = read_fact(spark, fact_path)
    check_path = write_quality(final_table_check(fact_back), f"{output_root}/final_check")
    append_run_log(spark, fact_back, f"{output_root}/run_log", step="etl", run_id=run_id)
    return {"fact_stock_risk": fact_back, "quality_checks": spark.read.parquet(quality_path),
            "final_check": spark.read.parquet(check_path), "run_log": read_run_log(spark, f"{output_root}/run_log"),
            "cleaned": without_time_partitions(cleaned)}


def run_etl_files(spark: SparkSession, specs: Sequence[SourceSpec], output_root: str, **kw) -> dict[str, DataFrame]:
    """D3 from source files: extract (S1-S4, landed and reported), then
    ``run_etl``.  A source that can't be read is an error of the run, after all
    others have been landed and the status is written."""
    tune(spark)
    frames, status = read_sources(spark, specs, f"{output_root}/landed")
    write_quality(status, f"{output_root}/source_status")
    failed = [f"{r['dataset']}: {r['error']}" for r in status.filter("status = 'error'").collect()]
    if failed:
        raise ValueError("; ".join(failed))
    return {**run_etl(spark, frames, output_root, **kw), "source_status": spark.read.parquet(f"{output_root}/source_status")}
