"""Quality and integrity checks as Spark jobs.

Each check is an aggregate over the whole table that returns a small
DataFrame.  The quality report runs as it is built: its counts come with the job
that finds the duplicates.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..schemas import QUALITY_CHECKS
from .aggregate import having_duplicates
from .duplicates import duplicate_profile


def quality_summary(df: DataFrame, dataset: str, keys: Sequence[str]) -> DataFrame:
    """Rows, columns, whole-row duplicates and NULLs of each key column (NULL
    for a column that the dataset lacks), from one pass over hashes of the rows;
    only rows that share a hash are compared whole."""
    found = duplicate_profile(df, [k for k in keys if k in df.columns])
    schema = ", ".join(f"`{c}` long" for c in ("rows", "columns", "duplicates", *(f"null_{k}" for k in keys)))
    row = (dataset, found["rows"], len(df.columns), found["duplicates"], *(found.get(f"null_{k}") for k in keys))
    return df.sparkSession.createDataFrame([row], f"dataset string, {schema}")


def union_ragged(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack report rows with different columns (missing -> NULL)."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def quality_report(cleaned: dict[str, DataFrame],
                   keys: dict[str, list[str]] | None = None) -> DataFrame:
    """E1 over every dataset, stacked with U1, in the report's column order."""
    keys = keys or P.QUALITY_KEYS
    rows = [quality_summary(cleaned[name], name, k) for name, k in keys.items() if name in cleaned]
    out = union_ragged(rows)
    for f in QUALITY_CHECKS.fields:
        if f.name not in out.columns:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in QUALITY_CHECKS.fields])


def final_table_check(df: DataFrame, keys: Sequence[str] = tuple(P.ID_COLUMNS),
                      label: str = P.LABEL) -> DataFrame:
    """E2 as rows (check, column, value): row count, column count, NULLs per
    column, duplicate keys, label distribution (NULL label kept).  One pass: the
    table is grouped by key and by label at once (grouping sets), the groups are
    summed to one row and one per label, and these are laid out as checks."""
    nulls = [f"_null_{c}" for c in df.columns]
    sets = df.groupingSets([[F.col(k) for k in keys], [F.col(label)]], *keys, label).agg(
        F.grouping(label).cast("int").alias("_by_key"), F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(n) for c, n in zip(df.columns, nulls)])
    none = df.sparkSession.range(1).select(                       # so that an empty table has its checks too
        F.lit(None).cast(df.schema[label].dataType).alias(label), F.lit(1).alias("_by_key"), F.lit(0).cast("long").alias("_n"),
        *[F.lit(0).cast("long").alias(n) for n in nulls])
    total = sets.select(label, "_by_key", "_n", *nulls).unionByName(none).groupBy("_by_key", label).agg(
        F.sum("_n").alias("_n"), F.sum(F.greatest(F.col("_n") - 1, F.lit(0))).alias("_repeats"),
        *[F.sum(n).alias(n) for n in nulls])

    def line(check, column, value):
        return F.struct(F.lit(check).alias("check"), column.cast("string").alias("column"), value.cast("long").alias("value"))

    whole = [line("rows", F.lit(None), F.col("_n")), line("columns", F.lit(None), F.lit(len(df.columns))),
             *(line("nulls", F.lit(c), F.col(n)) for c, n in zip(df.columns, nulls)),
             line("duplicate_keys", F.lit(",".join(keys)), F.col("_repeats"))]
    per_label = F.array(line("label_distribution", F.col(label), F.col("_n")))
    return total.select(F.inline(F.when(F.col("_by_key") == 1, F.array(*whole)).otherwise(per_label)))


def required_columns(spark: SparkSession, df: DataFrame, dataset: str,
                     required: Iterable[str]) -> DataFrame:
    """One expectation row per required column (schema metadata only)."""
    present = set(df.columns)
    rows = [(dataset, c, c in present) for c in required]
    return spark.createDataFrame(rows, "dataset string, column string, present boolean")


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return having_duplicates(df, keys, "nb")


def domain_check(df: DataFrame, column: str, domain: Iterable) -> DataFrame:
    """E5: rows whose non-NULL value is outside the domain."""
    domain = list(domain)
    return df.agg(F.count_if(~F.col(column).isin(domain) & F.col(column).isNotNull())
                  .alias("invalid_rows")).select(F.lit(column).alias("column"), "invalid_rows")


def non_negative_check(df: DataFrame, columns: Sequence[str] = tuple(P.NON_NEGATIVE_COLUMNS)) -> DataFrame:
    """Negative rows per column (0 everywhere = check passes)."""
    agg = df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in columns])
    return agg.unpivot([], list(columns), "column", "negative_rows").select(
        "column", F.col("negative_rows").cast("long"))
