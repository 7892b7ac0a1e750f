"""Daily partial sums (A2, A4, A6): any trailing window from one row per key and day.

    root/rows/batch=<id>/period=<date>/    landed rows of a batch (a replayed batch
                                           replaces itself)
    root/daily/period=<date>/              per key and day: sum, rows, latest time

A period is a day, or a month where days are too small to be folders.  A batch
refreshes the sums of the periods it touches, from the landed rows of these alone;
sums are made anew, never added to, so a batch may be replayed and may bring late
rows.  A window reads the sums of its whole days and the rows of the days on its
edges, so bounds hold to the microsecond.  A key that holds a third of all rows is
one row a day after the first, map-side aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .aggregate import days_before

DAY, BATCH, PERIOD = "day", "batch", "period"


def _read(spark: SparkSession, path: str, fields: list[tuple[str, T.DataType]], keys: Sequence[T.StructField]) -> DataFrame:
    return spark.read.schema(T.StructType([*keys, *(T.StructField(n, t) for n, t in fields)])).parquet(path)


class DailySums:
    """The rows and daily sums under ``root`` of one table: sums of ``value``
    (rows count 1 by default) per ``keys`` and day of ``ts``.  ``period`` is
    "day" or "month".  Rows without a time belong to no window and are left out."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[T.StructField], ts: str, value: str | None = None,
                 period: str = "day"):
        if period not in ("day", "month"):
            raise ValueError("period: day or month")
        self.spark, self.root, self.keys, self.ts, self.unit = spark, root.rstrip("/"), list(keys), ts, period
        self.names = [k.name for k in self.keys]
        self.value = F.col(value) if value else F.lit(1)

    def period(self, day: Column) -> Column:
        return F.trunc(day, "month") if self.unit == "month" else day

    def rows(self) -> DataFrame:
        read = _read(self.spark, f"{self.root}/rows", [("ts", T.TimestampNTZType()), ("value", T.DoubleType()),
                                                       (BATCH, T.StringType()), (PERIOD, T.DateType())], self.keys)
        return read.withColumn(DAY, F.to_date("ts"))

    def daily(self) -> DataFrame:
        return _read(self.spark, f"{self.root}/daily", [(DAY, T.DateType()), ("total", T.DoubleType()), ("n", T.LongType()),
                                                        ("latest", T.TimestampNTZType()), (PERIOD, T.DateType())], self.keys)

    def _exists(self, path: str) -> bool:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def _periods(self, df: DataFrame) -> set:
        return {r[0] for r in df.select(PERIOD).distinct().collect()}         # one value a period

    def add(self, batch: DataFrame, batch_id: str) -> list:
        """Land a batch and refresh the periods it touches, or touched when it
        was landed before under this id; those periods."""
        path = f"{self.root}/rows/{BATCH}={batch_id}"
        landed = F.col(BATCH) == batch_id
        before = self._periods(self.rows().filter(landed)) if self._exists(path) else set()
        (batch.select(*self.names, F.col(self.ts).cast("timestamp_ntz").alias("ts"), self.value.cast("double").alias("value"),
                      self.period(F.to_date(self.ts)).alias(PERIOD))
         .filter(F.col(PERIOD).isNotNull()).hint("rebalance", PERIOD).write.mode("overwrite").partitionBy(PERIOD).parquet(path))
        touched = sorted(before | self._periods(self.rows().filter(landed)))
        self.refresh(touched)
        return touched

    def refresh(self, periods: list) -> None:
        """Make the sums of some periods anew from their landed rows."""
        if not periods:
            return
        rows = self.rows().filter(F.col(PERIOD).isin(periods))
        sums = (rows.groupBy(*self.names, DAY, PERIOD)
                .agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest")))
        (sums.hint("rebalance", PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(PERIOD).parquet(f"{self.root}/daily"))
        for gone in set(periods) - self._periods(rows):               # a replay without this period's rows
            where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/daily/{PERIOD}={gone}")
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def anchor(self) -> Column:
        """A1 from the sums: the latest time of all."""
        return self.daily().select(F.max("latest")).scalar()

    def windows(self, days: dict[str, int], anchor: Column | None = None) -> DataFrame:
        """Per key: the sum over each trailing window (alias -> days) that ends
        at ``anchor``, both bounds inclusive, and the rows of the longest window
        (``n_rows``); keys without rows in it are left out."""
        end = self.anchor() if anchor is None else anchor
        last = F.to_date(end)
        begin = {a: days_before(end, n) for a, n in days.items()}
        longest = max(days, key=days.get)
        first = F.to_date(begin[longest])

        def parts(df, inside, value, n):
            return df.select(*self.names, *(F.when(inside[a], value).otherwise(F.lit(0.0)).alias(a) for a in days),
                             F.when(inside[longest], n).otherwise(F.lit(0)).cast("long").alias("n_rows"))

        whole = self.daily().filter((F.col(DAY) > first) & (F.col(DAY) < last) & (F.col(PERIOD) >= self.period(first)))
        whole = parts(whole, {a: F.col(DAY) > F.to_date(b) for a, b in begin.items()}, F.col("total"), F.col("n"))
        on_edge = {a: (F.col(DAY) == F.to_date(b)) | (F.col(DAY) == last) for a, b in begin.items()}
        edge = F.col(PERIOD).isin(*(self.period(d) for d in (last, *(F.to_date(b) for b in begin.values()))))
        edges = self.rows().filter(edge & reduce(lambda x, y: x | y, on_edge.values()) & (F.col("ts") <= end))
        edges = parts(edges, {a: on_edge[a] & (F.col("ts") >= b) for a, b in begin.items()}, F.col("value"), F.lit(1))
        return (whole.unionByName(edges).groupBy(*self.names)
                .agg(*(F.sum(a).cast("long").alias(a) for a in days), F.sum("n_rows").alias("n_rows"))
                .filter("n_rows > 0"))
