"""Property tests: Spark operators against plain-Python statements of the
same rule on random small inputs."""

from __future__ import annotations

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfrisk.operators import clean as C
from shelfrisk.operators import ml as M

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

text = st.text(alphabet=st.sampled_from(list("aBcD éÉ-_") + [" ", "\t", "\n", "\r", "\x0b", "\x0c"]),
               max_size=12)


@SETTINGS
@given(st.lists(st.one_of(st.none(), text), min_size=1, max_size=20))
def test_normalize_matches_python_strip_lower(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = [r.c for r in C.normalize_text(df, ["c"]).collect()]
    assert got == [None if v is None else v.strip().lower() for v in values]


rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.integers(min_value=0, max_value=5),
                          st.integers(min_value=-3, max_value=3)), min_size=1, max_size=40)


@SETTINGS
@given(rows, st.integers(min_value=1, max_value=6))
def test_latest_per_key_is_lexicographic_max(spark, data, parts):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, base + dt.timedelta(days=d), v) for k, d, v in data],
                               "k string, ts timestamp_ntz, v long").repartition(parts)
    got = {r.k: (r.ts, r.v) for r in C.latest_per_key(df, ["k"], ["ts", "v"]).collect()}
    want = {}
    for k, d, v in data:
        cand = (base + dt.timedelta(days=d), v)
        want[k] = max(want.get(k, cand), cand)
    assert got == want


@SETTINGS
@given(st.integers(min_value=2, max_value=60), st.integers(min_value=2, max_value=60))
def test_strata_share_the_rule_size(spark, n0, n1):
    data = [(f"p{i}", f"s{c}", c) for c, n in ((0, n0), (1, n1)) for i in range(n)]
    df = spark.createDataFrame(data, "product_id string, store_id string, stockout_risk int")
    t = min(max(0.2, 1 / min(n0, n1)), 0.5)
    got = {r.stockout_risk: r.n for r in
           M.stratified_split(df).filter(F.col("is_test")).groupBy("stockout_risk").count()
           .withColumnRenamed("count", "n").collect()}
    # ceil(t * n) rows in all, dealt by largest remainder (ties: the smaller label)
    n = n0 + n1
    total = math.ceil(round(t * n, 6))
    want = {0: total * n0 // n, 1: total * n1 // n}
    for c in sorted((0, 1), key=lambda c: (-(total * (n0, n1)[c] % n), c))[:total - sum(want.values())]:
        want[c] += 1
    assert got == {c: min(max(want[c], 1), (n0, n1)[c] - 1) for c in (0, 1)}
