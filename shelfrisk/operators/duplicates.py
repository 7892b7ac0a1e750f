"""Exact duplicates by row hash.

Whole rows are wide; what tells them apart is not.  Rows are first counted by a
64-bit hash of all their columns, so the shuffle of the whole table carries 8
bytes a row, counted map-side.  Hashes that occur once are no duplicates, as equal
rows have equal hashes.  Only rows of the other hashes, the suspects, are compared
as whole rows, so the result is exact whatever collides; a table without
duplicates needs no second pass.  The suspects' hashes are stored and counted
first: up to ``MAX_BROADCAST`` of them are broadcast to find their rows; beyond
that every row is compared whole, in one shuffle, which moves less than a join
that looks for them.

Rows are equal as in ``DISTINCT``: NULLs are equal, -0.0 equals 0.0.  The input is
read twice and must give the same rows each time (files do).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path

KEY = ("_row_hash_1",)
MAX_BROADCAST = 4_000_000            # hashes of 8 bytes
RowKey = Callable[[DataFrame], list[Column]]


def row_key(df: DataFrame) -> list[Column]:
    """A 64-bit hash of the whole row.  The hash function skips NULLs, so
    which columns are NULL is hashed too."""
    empty = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in df.columns])
    return [F.xxhash64(F.lit("first"), empty, *df.columns)]


def _keyed(df: DataFrame, key: RowKey) -> DataFrame:
    return df.withColumns(dict(zip(KEY, key(df))))


def suspects(df: DataFrame, nulls: Sequence[str] = (), key: RowKey = row_key) -> tuple[DataFrame, dict[str, int]]:
    """The hashes that occur more than once, stored, and from the same job the
    number of rows (``rows``), of such hashes (``suspects``) and of NULLs in ``nulls``."""
    spark, seen, found = df.sparkSession, Observation(), Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nulls))
    repeated = (counted.select(*(c.alias(n) for n, c in zip(KEY, key(df)))).groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"))
                .filter("_n > 1").select(*KEY).observe(found, F.count(F.lit(1)).alias("suspects")))
    path = scratch_path(spark, "row-hashes")
    repeated.write.parquet(path)
    try:
        counts = {**seen.get, **found.get}
    except Py4JJavaError:                # a plan that turns out empty is cut off, and its counters with it
        if not df.isEmpty():
            raise
        counts = dict.fromkeys(["rows", "suspects", *(f"null_{c}" for c in nulls)], 0)
    return spark.read.schema(repeated.schema).parquet(path), counts


def dedupe_exact_by_hash(df: DataFrame, key: RowKey = row_key) -> DataFrame:
    """One of each set of equal rows.  Rows whose hash is their own pass
    without a shuffle."""
    hashes, seen = suspects(df, key=key)
    if not seen["suspects"]:
        return df
    if seen["suspects"] > MAX_BROADCAST:
        return df.distinct()
    keyed, hashes = _keyed(df, key), F.broadcast(hashes)
    alone = keyed.join(hashes, list(KEY), "left_anti").drop(*KEY)
    shared = keyed.join(hashes, list(KEY), "left_semi").drop(*KEY)
    return alone.union(shared.distinct())


def duplicate_profile(df: DataFrame, nulls: Sequence[str] = (), key: RowKey = row_key) -> dict[str, int]:
    """A13 + A14: rows, rows that repeat another (``duplicates``) and NULLs of
    some columns."""
    hashes, seen = suspects(df, nulls, key)
    repeats, found = 0, seen.pop("suspects")
    if found:
        few = found <= MAX_BROADCAST
        shared = _keyed(df, key).join(F.broadcast(hashes), list(KEY), "left_semi").drop(*KEY) if few else df
        repeats = shared.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).agg(F.sum(F.col("_n") - 1)).first()[0]
    return {**seen, "duplicates": repeats}
