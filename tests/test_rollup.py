"""Daily sums and the co-located pair layer against the one-pass forms."""

from __future__ import annotations

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import raw_frames
from shelfrisk.operators.aggregate import sales_two_horizons
from shelfrisk.operators.rollup import DailySums
from shelfrisk.plans import colocated as P
from shelfrisk.plans.etl import clean_sources, fact_from_clean

KEYS = [T.StructField("product_id", T.StringType()), T.StructField("store_id", T.StringType())]
START = dt.datetime(2024, 1, 1)
WINDOWS = {"sales_7d": 7, "sales_30d": 30}


def orders(spark, n=400, days=60, seed=1):
    """Times of any microsecond, a pair that holds a third of the rows, a null key."""
    rng = random.Random(seed)
    rows = [(None if i == 5 else f"p{rng.randrange(6)}", f"s{rng.randrange(3)}" if i % 3 else "s0",
             START + dt.timedelta(microseconds=rng.randrange(days * 86_400_000_000)), float(rng.randrange(1, 9))) for i in range(n)]
    rows = [("p0", "s0", r[2], r[3]) if i % 3 == 0 else r for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "product_id string, store_id string, order_date timestamp_ntz, quantity double")


def table(df, columns=("product_id", "store_id", "sales_7d", "sales_30d")):
    return sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))


def sums(spark, root, period="day"):
    return DailySums(spark, root, KEYS, "order_date", "quantity", period)


@pytest.mark.parametrize("back,period", [(0, "day"), (8.25, "day"), (0, "month"), (3, "month"), (41.999, "month")])
def test_windows_equal_the_one_pass_form(spark, tmpdir_fresh, back, period):
    df = orders(spark)
    daily = sums(spark, tmpdir_fresh, period)
    daily.add(df.filter("order_date < '2024-01-20'"), "a")
    daily.add(df.filter("order_date >= '2024-01-20'"), "b")
    end = df.agg(F.max("order_date")).first()[0]
    assert spark.range(1).select(daily.anchor()).first()[0] == end
    end -= dt.timedelta(days=back)
    then = df.filter(F.col("order_date") <= F.lit(end))
    last = then.agg(F.max("order_date")).first()[0]          # the one-pass form ends its windows at the last row
    assert table(daily.windows(WINDOWS, F.lit(last))) == table(sales_two_horizons(then))


def test_bounds_are_inclusive(spark, tmpdir_fresh):
    end = dt.datetime(2024, 3, 1, 12, 30)
    times = [end, end - dt.timedelta(days=7), end - dt.timedelta(days=7, microseconds=1), end - dt.timedelta(days=30),
             end - dt.timedelta(days=30, microseconds=1), end + dt.timedelta(microseconds=1)]
    df = spark.createDataFrame([("p", "s", t, 10.0**i) for i, t in enumerate(times)],
                               "product_id string, store_id string, order_date timestamp_ntz, quantity double")
    daily = sums(spark, tmpdir_fresh)
    daily.add(df, "a")
    got = daily.windows(WINDOWS, F.lit(end)).first()
    assert (got.sales_7d, got.sales_30d, got.n_rows) == (11, 1111, 4)


def test_replays_late_rows_and_empty_batches(spark, tmpdir_fresh):
    df = orders(spark)
    early, late = df.filter("order_date < '2024-02-01'"), df.filter("order_date >= '2024-02-01'")
    daily = sums(spark, tmpdir_fresh, "month")
    assert daily.add(df.limit(0), "none") == []
    daily.add(late, "a")
    daily.add(orders(spark, seed=9), "b")                     # a wrong batch,
    daily.add(early, "b")                                     # replayed with the right rows
    daily.add(late.withColumn("order_date", F.lit(None).cast("timestamp_ntz")), "no times")
    daily.add(late, "a")
    assert table(daily.windows(WINDOWS)) == table(sales_two_horizons(df))
    assert daily.daily().agg(F.sum("n")).first()[0] == df.count()


def test_a_batch_reads_only_its_days(spark, tmpdir_fresh):
    """Older days' rows may even be unreadable."""
    df = orders(spark)
    daily = sums(spark, tmpdir_fresh)
    daily.add(df.filter("order_date < '2024-02-10'"), "a")
    for path in glob.glob(f"{tmpdir_fresh}/rows/batch=a/period=2024-01-*/*.parquet"):
        with open(path, "wb") as f:
            f.write(b"gone")
    days = daily.add(df.filter("order_date >= '2024-02-10'"), "b")
    assert min(days) == dt.date(2024, 2, 10)
    assert daily.daily().agg(F.sum("n")).first()[0] == df.count()


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line for line in plan.splitlines()), plan


def test_pair_join_without_exchange(spark, tmpdir_fresh):
    cl = clean_sources(raw_frames(spark))
    prefix = "pairs_test_"
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    sales, stock = P.store_pairs(sales_two_horizons(cl["orders"]), cl["inventory"], tmpdir_fresh, prefix, buckets=4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        from shelfrisk.operators.joins import join_stock

        n, plan = exchanges(join_stock(sales, stock))
        assert n == 0 and "SortMergeJoin" in plan
        fact = P.fact_from_pairs(sales, stock, cl["products"], cl["stores"], cl["reviews"], cl["events"])
        assert sorted(map(str, fact.collect())) == sorted(map(str, fact_from_clean(cl).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        P.forget(spark, prefix)
    assert not spark.catalog.tableExists(f"{prefix}sales")
