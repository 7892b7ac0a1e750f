"""A hot key (a third of all rows) must not change results; checked against a
brute-force pandas computation of the same rules on a small fixture."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from shelfrisk.operators import aggregate as A
from shelfrisk.operators import clean as C
from shelfrisk.plans.fact import build_fact_stock_risk

N = 3000


def _orders(spark):
    base = dt.datetime(2024, 3, 31)
    return (spark.range(N)
            .select(F.concat(F.lit("O"), F.col("id").cast("string")).alias("order_id"),
                    (F.lit(base) - F.make_dt_interval(F.col("id") % 45)).cast("timestamp_ntz").alias("order_date"),
                    F.lit(None).cast("string").alias("customer_id"),
                    F.when(F.col("id") % 3 == 0, F.lit("HOT"))
                     .otherwise(F.concat(F.lit("P"), (F.col("id") % 50).cast("string"))).alias("product_id"),
                    F.when(F.col("id") % 3 == 0, F.lit("S0"))
                     .otherwise(F.concat(F.lit("S"), (F.col("id") % 7).cast("string"))).alias("store_id"),
                    (F.col("id") % 9 + 1).cast("int").alias("quantity"),
                    F.lit(1.0).alias("unit_price"), F.lit("web").alias("channel")))


def _inventory(spark):
    base = dt.datetime(2024, 3, 1)
    return (spark.range(N)
            .select(F.when(F.col("id") % 3 == 0, F.lit("HOT"))
                     .otherwise(F.concat(F.lit("P"), (F.col("id") % 50).cast("string"))).alias("product_id"),
                    F.when(F.col("id") % 3 == 0, F.lit("S0"))
                     .otherwise(F.concat(F.lit("S"), (F.col("id") % 7).cast("string"))).alias("store_id"),
                    (F.col("id") % 13).alias("stock_qty"),
                    (F.lit(base) + F.make_dt_interval(F.col("id") % 20)).cast("timestamp_ntz").alias("last_update")))


def test_hot_key_sales_and_latest_match_brute_force(spark):
    orders = _orders(spark).repartition(6)
    inv = _inventory(spark).repartition(6)
    got = {(r.product_id, r.store_id): (r.sales_7d, r.sales_30d)
           for r in A.sales_two_horizons(orders).collect()}
    pdf = orders.toPandas()
    anchor = pdf.order_date.max()
    w30 = pdf[pdf.order_date >= anchor - pd.Timedelta(days=30)]
    w7 = pdf[pdf.order_date >= anchor - pd.Timedelta(days=7)]
    s30 = w30.groupby(["product_id", "store_id"]).quantity.sum()
    s7 = w7.groupby(["product_id", "store_id"]).quantity.sum()
    want = {k: (int(s7.get(k, 0)), int(v)) for k, v in s30.items()}
    assert got == want
    assert got[("HOT", "S0")][1] > 10 * max(v[1] for k, v in got.items() if k != ("HOT", "S0"))

    latest = {(r.product_id, r.store_id): r.stock_qty
              for r in C.latest_per_key(inv, ["product_id", "store_id"], ["last_update", "stock_qty"]).collect()}
    ip = inv.toPandas().sort_values(["last_update", "stock_qty"])
    want_latest = ip.groupby(["product_id", "store_id"]).tail(1)
    assert latest == {(r.product_id, r.store_id): r.stock_qty for r in want_latest.itertuples()}


def test_hot_key_fact_has_one_row_per_pair(spark):
    orders = _orders(spark)
    inv = C.clean_inventory(_inventory(spark))
    products = spark.createDataFrame([("HOT", "x", "c", "b", None, None)] +
                                     [(f"P{i}", "x", "c", "b", None, None) for i in range(50)],
                                     "product_id string, product_name string, category string, brand string, "
                                     "cost_price double, sale_price double")
    stores = spark.createDataFrame([(f"S{i}", "s", "c", "r", None) for i in range(7)],
                                   "store_id string, store_name string, city string, region string, "
                                   "opening_date timestamp_ntz")
    reviews = spark.createDataFrame([("R1", "HOT", 5, "", None)], "review_id string, product_id string, "
                                    "rating long, comment string, review_date timestamp_ntz")
    events = spark.createDataFrame([("E1", "HOT", "view", dt.datetime(2024, 3, 31), "web")],
                                   "event_id string, product_id string, event_type string, "
                                   "event_ts timestamp_ntz, source string")
    fact = build_fact_stock_risk(orders, products, stores, inv, reviews, events)
    pairs = A.sales_two_horizons(orders).count()
    assert fact.count() == pairs
    assert fact.groupBy("product_id", "store_id").count().filter("count > 1").count() == 0
    hot = fact.filter("product_id = 'HOT'").first()
    assert hot.avg_rating == 5.0 and hot.web_signal == 1 and hot.region == "r"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
