from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fixtures import EXPECTED_FACT, EXPECTED_REPAIRED_EXTRA, raw_frames
from shelfrisk import params as P
from shelfrisk.operators import aggregate as A
from shelfrisk.operators import clean as C
from shelfrisk.plans.etl import clean_sources, fact_from_clean

BOTH = (P.ISO_DATE, P.DAY_FIRST_DATE)


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_fact_golden_iso(spark):
    fact = fact_from_clean(clean_sources(raw_frames(spark)))
    assert fact.columns == P.FACT_COLUMNS
    assert rows(fact) == EXPECTED_FACT


def test_fact_golden_repaired(spark):
    fact = fact_from_clean(clean_sources(raw_frames(spark), BOTH))
    assert rows(fact) == EXPECTED_FACT | {EXPECTED_REPAIRED_EXTRA}


def test_fact_invariants(spark):
    cl = clean_sources(raw_frames(spark))
    fact = fact_from_clean(cl)
    # grain holds, 7 d <= 30 d, flag equals the rule, nothing negative
    assert fact.groupBy("product_id", "store_id").count().filter("count > 1").count() == 0
    assert fact.filter("sales_7d > sales_30d").count() == 0
    rule = ((F.col("stock_qty") < 10) & (F.col("sales_7d") > 5)).cast("int")
    assert fact.filter(rule != F.col("stockout_risk")).count() == 0
    for c in P.NON_NEGATIVE_COLUMNS:
        assert fact.filter(F.col(c) < 0).count() == 0
    # fact keys = distinct pairs sold in the last 30 days (no gain through joins)
    sold = A.sales_two_horizons(cl["orders"]).select("product_id", "store_id")
    assert rows(sold) == rows(fact.select("product_id", "store_id"))


def test_clean_orders_rules(spark):
    raw = raw_frames(spark)["orders"]
    out = C.clean_orders(raw)
    ids = sorted(r.order_id for r in out.collect())
    # duplicate collapsed; day-first, empty/zero/negative quantity, NULL key dropped
    assert ids == sorted(["O1", "O2", "O3", "O4", "O5", "O10", "O11", "O12", "O13"])
    assert dict(out.dtypes)["order_date"] == "timestamp_ntz"
    assert dict(out.dtypes)["quantity"] == "double"
    repaired = C.clean_orders(raw, BOTH)
    assert repaired.filter("order_id = 'O6'").first().order_date == dt.datetime(2024, 3, 15)
    # empty price is NULL, not a dropped row
    assert out.filter("order_id = 'O4'").first().unit_price is None


def test_keep_first_and_latest(spark):
    raw = raw_frames(spark)
    prods = C.clean_products(raw["products"])
    assert prods.filter("product_id = 'P3'").count() == 1
    assert prods.filter("product_id = 'P3'").first().product_name == "cable"
    assert prods.filter("product_id = 'P8'").first().sale_price is None
    inv = {(r.product_id, r.store_id): r.stock_qty for r in C.clean_inventory(raw["inventory"]).collect()}
    assert inv[("P1", "S1")] == 8 and inv[("P2", "S1")] == 0 and inv[("P3", "S1")] == 0
    assert inv[("P7", "S2")] == 10
    unclipped = {(r.product_id, r.store_id): r.stock_qty
                 for r in C.load_inventory(raw["inventory"]).collect()}
    assert unclipped[("P2", "S1")] == -3 and unclipped[("P3", "S1")] is None


def test_latest_ties_are_deterministic(spark):
    df = spark.createDataFrame([("a", 1, dt.datetime(2024, 1, 1)), ("a", 7, dt.datetime(2024, 1, 1)),
                                ("a", 3, dt.datetime(2023, 1, 1))], "k string, v long, ts timestamp_ntz")
    for parts in (1, 3):
        out = C.latest_per_key(df.repartition(parts), ["k"], ["ts", "v"]).collect()
        assert [(r.k, r.v) for r in out] == [("a", 7)]


def test_reviews_and_events(spark):
    raw = raw_frames(spark)
    rev = C.clean_reviews(raw["reviews"])
    assert rows(rev.select("review_id", "rating")) == {("R1", 4), ("R2", 2)}
    ev = C.clean_events(raw["events"])
    assert rows(ev.select("event_id", "event_type")) == {("E1", "view"), ("E2", "view"),
                                                          ("E3", "cart"), ("E5", "wishlist")}
    web = {r.product_id: r.web_signal for r in A.web_signal(ev).collect()}
    assert web == {"P1": 2, "P2": 1}


def test_normalize_strips_all_outer_whitespace(spark):
    df = spark.createDataFrame([("\t Mixed Case \n",), (None,)], "c string")
    out = [r.c for r in C.normalize_text(df, ["c", "absent"]).collect()]
    assert out == ["mixed case", None]


def test_tolerant_parse_under_ansi(spark):
    df = spark.createDataFrame([(" 7 ",), ("x",), ("",), (None,), ("1e3",)], "q string")
    got = [r.q for r in C.parse_doubles(df, ["q"]).collect()]
    assert got == [7.0, None, None, None, 1000.0]


def test_two_horizons_equal_outer_merge(spark):
    orders = C.clean_orders(raw_frames(spark)["orders"])
    assert rows(A.sales_two_horizons(orders)) == rows(A.sales_outer_merge(orders).select(
        "product_id", "store_id", "sales_30d", "sales_7d"))


def test_generic_aggregates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2)], "k string, v int")
    assert A.duplicate_row_count(df).first().duplicates == 1
    assert A.duplicate_row_count(df, ["k"]).first().duplicates == 1
    assert rows(A.having_duplicates(df, ["k"])) == {("a", 2)}
    assert A.null_counts(df).first().asDict() == {"null_k": 1, "null_v": 1}
    assert rows(A.value_counts(df, "k")) == {("a", 2), ("b", 1)}
    assert rows(A.value_counts(df, "k", dropna=False)) == {("a", 2), ("b", 1), (None, 1)}
    assert A.distinct_count(df, "k").first()[0] == 2
    assert A.negative_counts(df, ["v"]).first()[0] == 0


def test_stock_filled_after_the_latest_reading(spark):
    """CL4 is C11 and C12 on what CL8 loads: NULL, negative and tied stocks, odd times and keys."""
    import itertools
    stocks = [None, -3, 0, 4]
    rows = [(f"p{i}", "s", a, "2024-01-01T00:00:00") for i, pair in enumerate(itertools.product(stocks, stocks)) for a in pair]
    rows += [("p0", "s", -9, "2024-01-02T00:00:00"), ("p1", "s", 7, "unknown"), (None, "s", 1, "2024-01-01"), ("q", None, 1, "2024-01-01")]
    raw = spark.createDataFrame(rows, "product_id string, store_id string, stock_qty long, last_update string").repartition(3)
    late, early = C.fill_stock(C.load_inventory(raw)), C.clean_inventory(raw)
    assert late.columns == early.columns
    assert sorted(map(str, late.collect())) == sorted(map(str, early.collect())) and early.count() == 16


def test_a_pick_carries_each_column_once(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z")], "k string, o long, r string")
    got = C.latest_per_key(df, ["k"], ["o"])
    packed = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_o0" not in packed and got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [("a", 2, "y"), ("b", None, "z")]
