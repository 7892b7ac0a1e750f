"""Aggregations.

All aggregates are built-in (partial aggregation before the shuffle).  The
time anchor (A1) is a scalar subquery, evaluated once and used in the scan's
filter, never a join and never a value collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P


# --- A1 / A2 ---------------------------------------------------------------

def max_anchor(df: DataFrame, column: str) -> Column:
    """A1: global max of ``column`` as a scalar-subquery column."""
    return df.select(F.max(column)).scalar()


def days_before(anchor: Column, days: int) -> Column:
    return anchor - F.make_dt_interval(F.lit(days))


def month_of(ts: Column | str) -> Column:
    """First day of the month of ``ts`` (the time partition value)."""
    return F.trunc(F.col(ts) if isinstance(ts, str) else ts, "month")


def window_filter(df: DataFrame, ts: str, since: Column, part_col: str | None = None) -> DataFrame:
    """``ts >= since``; when the table is partitioned by the month of ``ts``
    (``part_col``), the same bound on that column lets the scan skip every
    older partition (the subquery is evaluated before the files are listed)."""
    out = df.filter(F.col(ts) >= since)
    if part_col and part_col in df.columns:
        out = out.filter(F.col(part_col) >= month_of(since))
    return out


def trailing_window(df: DataFrame, ts: str, days: int,
                    anchor: Column | None = None, part_col: str | None = None) -> DataFrame:
    """A2: rows with ``ts >= anchor - days`` (lower bound inclusive).  The
    anchor defaults to the frame's own max(ts)."""
    anchor = max_anchor(df, ts) if anchor is None else anchor
    return window_filter(df, ts, days_before(anchor, days), part_col)


# --- A3 / A4: demand ---------------------------------------------------------

def grouped_sum(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """A3."""
    return df.groupBy(*keys).agg(F.sum(value).cast("long").alias(alias))


def sales_two_horizons(orders: DataFrame, short_days: int = P.SHORT_WINDOW_DAYS,
                       long_days: int = P.LONG_WINDOW_DAYS,
                       ts: str = "order_date", qty: str = "quantity",
                       keys: Sequence[str] = ("product_id", "store_id"),
                       part_col: str = "order_month") -> DataFrame:
    """A4: sales over the short and long trailing windows in one pass.  The
    short-window rows are a subset of the long-window rows, so the reference's
    two aggregates + outer merge equal one filtered conditional sum."""
    anchor = max_anchor(orders, ts)
    recent = window_filter(orders, ts, days_before(anchor, long_days), part_col)
    short_from = days_before(anchor, short_days)
    return recent.groupBy(*keys).agg(
        F.sum(F.when(F.col(ts) >= short_from, F.col(qty)).otherwise(F.lit(0))).cast("long").alias("sales_7d"),
        F.sum(qty).cast("long").alias("sales_30d"),
    ).select(*keys, "sales_30d", "sales_7d")


def sales_outer_merge(orders: DataFrame, short_days: int = P.SHORT_WINDOW_DAYS,
                      long_days: int = P.LONG_WINDOW_DAYS, ts: str = "order_date",
                      qty: str = "quantity",
                      keys: Sequence[str] = ("product_id", "store_id")) -> DataFrame:
    """J1 kept as a standalone operator: two windowed sums merged with a full
    outer join, missing side filled with 0.  Same result as A4; A4 is what the
    fact table uses (one scan, one shuffle)."""
    anchor = max_anchor(orders, ts)
    s30 = grouped_sum(orders.filter(F.col(ts) >= days_before(anchor, long_days)), keys, qty, "sales_30d")
    s7 = grouped_sum(orders.filter(F.col(ts) >= days_before(anchor, short_days)), keys, qty, "sales_7d")
    merged = s30.join(s7, list(keys), "full")
    return merged.select(*keys, F.coalesce("sales_30d", F.lit(0)).cast("long").alias("sales_30d"),
                         F.coalesce("sales_7d", F.lit(0)).cast("long").alias("sales_7d"))


# --- A5 / A6: reviews and web demand ---------------------------------------

def review_features(reviews: DataFrame) -> DataFrame:
    """A5: mean rating, review count and latest review date per product."""
    return reviews.groupBy("product_id").agg(
        F.avg(F.col("rating").cast("double")).alias("avg_rating"),
        F.count("review_id").alias("nb_reviews"),
        F.max("review_date").alias("last_review_date"),
    )


def web_signal(events: DataFrame, days: int = P.LONG_WINDOW_DAYS,
               ts: str = "event_ts", part_col: str = "event_month") -> DataFrame:
    """Events per product in the trailing window of the events' own clock."""
    return (trailing_window(events, ts, days, part_col=part_col)
            .groupBy("product_id").agg(F.count(F.lit(1)).alias("web_signal")))


# --- A7-A15: generic aggregates ------------------------------------------

def value_counts(df: DataFrame, column: str, dropna: bool = True,
                 alias: str = "count") -> DataFrame:
    """(value, count); NULL is a value only when ``dropna`` is False."""
    src = df.filter(F.col(column).isNotNull()) if dropna else df
    return src.groupBy(column).agg(F.count(F.lit(1)).alias(alias))


def group_mean(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """A8 (SQL form: NULL key is a group)."""
    return df.groupBy(key).agg(F.avg(F.col(value).cast("double")).alias(alias))


def having_duplicates(df: DataFrame, keys: Sequence[str], alias: str = "nb") -> DataFrame:
    """A10: keys occurring more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
              .filter(F.col(alias) > 1))


def distinct_count(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Number of distinct non-NULL values (nunique)."""
    return df.agg(F.count_distinct(column).alias(alias or f"nunique_{column}"))


def minority_count(df: DataFrame, column: str) -> DataFrame:
    """Number of classes and the smallest class size."""
    counts = value_counts(df, column)
    return counts.agg(F.count(F.lit(1)).alias("n_classes"),
                      F.min("count").alias("minority_count"))


def duplicate_row_count(df: DataFrame, keys: Sequence[str] | None = None,
                        alias: str = "duplicates") -> DataFrame:
    """Rows that repeat an earlier row (whole row, or only ``keys``):
    sum over groups of (n - 1); pre-aggregated map-side."""
    cols = list(keys) if keys else df.columns
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
              .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias(alias)))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None,
                prefix: str = "null_") -> DataFrame:
    """NULL count of every column, one pass."""
    cols = list(columns) if columns else df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{prefix}{c}") for c in cols])


def negative_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows violating ``c >= 0`` per column (0 means the predicate holds
    for all rows)."""
    return df.agg(*[F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in columns])
