"""C1 / A13 / E1 by row hash, E2 in one pass and M2 by ranges, against the plain forms."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfrisk.operators import duplicates as D
from shelfrisk.operators import ml as M
from shelfrisk.operators.aggregate import duplicate_row_count, null_counts, value_counts
from shelfrisk.operators.quality import final_table_check, quality_summary

KEYS = {
    "whole": D.row_key,
    "all rows collide": lambda df: [F.lit(1).cast("long"), F.lit(2).cast("long")],
    "some rows collide": lambda df: [F.length(F.coalesce("a", F.lit(""))).cast("long"), F.lit(0).cast("long")],
}


def sample(spark, n=300, hot=100):
    """Rows with NULLs, either zero, NaN, values that move between columns, and a third that are copies."""
    rng = random.Random(n)
    rows = [(rng.choice(["x", "xy", None, ""]), rng.choice(["x", None, ""]), rng.choice([0.0, -0.0, float("nan"), None, 1.5]),
             rng.choice([None, 1, 2])) for _ in range(n)]
    return spark.createDataFrame(rows + [("hot", None, 0.0, 1)] * hot, "a string, b string, c double, d long").repartition(5)


def bag(df):
    return sorted(map(str, df.withColumn("c", F.col("c") + 0.0).collect()))


@pytest.mark.parametrize("key", KEYS)
def test_distinct_rows(spark, key):
    df = sample(spark)
    got = D.dedupe_exact_by_hash(df, KEYS[key])
    assert got.columns == df.columns and bag(got) == bag(df.distinct())


@pytest.mark.parametrize("key", KEYS)
def test_profile(spark, key):
    df = sample(spark)
    got = D.duplicate_profile(df, ["a", "d"], KEYS[key])
    nulls = null_counts(df, ["a", "d"]).first().asDict()
    assert got == {"rows": df.count(), "duplicates": duplicate_row_count(df).first()[0], **nulls}


def test_no_duplicates_and_no_rows(spark):
    df = spark.range(50).select("id", F.lit(None).cast("string").alias("a"), F.lit(1.0).alias("c"))
    assert D.duplicate_profile(df) == {"rows": 50, "duplicates": 0}
    assert D.dedupe_exact_by_hash(df) is df                          # nothing to compare, nothing shuffled
    assert D.duplicate_profile(df.limit(0), ["a"]) == {"rows": 0, "duplicates": 0, "null_a": 0}
    assert quality_summary(df.limit(0), "x", ["a", "gone"]).first().asDict() == {
        "dataset": "x", "rows": 0, "columns": 3, "duplicates": 0, "null_a": 0, "null_gone": None}


def test_the_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame([("x", None), (None, "x"), ("x", ""), ("", "x"), (None, None), ("", "")], "a string, b string")
    assert df.select(*D.row_key(df)).distinct().count() == 6


def exchanged(df):
    """Columns that cross each exchange of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line and "Reused" not in line]


def test_whole_rows_do_not_cross_the_first_shuffle(spark):
    """The plan that finds the suspects exchanges two hashes and a count."""
    df = sample(spark)
    counted = df.select(*(c.alias(n) for n, c in zip(D.KEY, D.row_key(df)))).groupBy(*D.KEY).agg(F.count("*").alias("_n"))
    lines = [x for x in exchanged(counted) if "hashpartitioning(_row_hash_1" in x]
    assert len(lines) == 1
    assert [f.name for f in counted.schema] == [*D.KEY, "_n"]


def plain_check(df, keys, label):
    out = [("rows", None, df.count()), ("columns", None, len(df.columns)),
           ("duplicate_keys", ",".join(keys), duplicate_row_count(df, keys).first()[0])]
    out += [("nulls", c.removeprefix("null_"), n) for c, n in null_counts(df).first().asDict().items()]
    return out + [("label_distribution", None if r[0] is None else str(r[0]), r[1]) for r in value_counts(df, label, dropna=False).collect()]


def test_final_check_in_one_pass(spark):
    df = sample(spark)
    got = final_table_check(df, ["a", "b"], "d")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain_check(df, ["a", "b"], "d")))
    none = df.limit(0)
    assert sorted(map(str, map(tuple, final_table_check(none, ["a", "b"], "d").collect()))) == sorted(map(str, plain_check(none, ["a", "b"], "d")))


def test_final_check_scans_once(spark, tmpdir_fresh):
    sample(spark).write.parquet(f"{tmpdir_fresh}/t")
    check = final_table_check(spark.read.parquet(f"{tmpdir_fresh}/t"), ["a", "b"], "d")
    plan = check._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_dictionary_by_ranges(spark):
    """A column of 10^6 values, one of a few, one of NULLs: as the window form ranks them."""
    df = spark.range(1_000_000).select(F.xxhash64("id").cast("string").alias("many"), (F.col("id") % 7).alias("few"),
                                       F.lit(None).cast("string").alias("none"))
    got = M.encoding_dictionary(df, ["many", "few", "none"])
    long = df.select(F.lit("many").alias("column"), F.col("many").alias("value")).union(
        df.select(F.lit("few"), F.col("few").cast("string"))).distinct()
    want = long.withColumn("index", (F.dense_rank().over(Window.partitionBy("column").orderBy("value")) - 1).cast("int"))
    assert got.count() == 1_000_007 and got.exceptAll(want).limit(1).count() == 0
    assert M.encoding_dictionary(df.limit(0), ["many"]).count() == 0


def test_one_narrow_hash_crosses_the_first_shuffle(spark):
    """8 bytes a row, not 16: what collides is compared whole."""
    df = sample(spark)
    assert [c for c in df.select(*D.row_key(df)).dtypes if c[1] == "bigint"] == df.select(*D.row_key(df)).dtypes
    assert len(D.row_key(df)) == len(D.KEY) == 1


@pytest.mark.parametrize("most", [0, 1000])
def test_many_suspects_need_no_join(spark, monkeypatch, most):
    """Up to a bound the suspects are broadcast; beyond it no row is looked up."""
    monkeypatch.setattr(D, "MAX_BROADCAST", most)
    df = sample(spark)
    assert D.duplicate_profile(df)["duplicates"] == duplicate_row_count(df).first()[0]
    got = D.dedupe_exact_by_hash(df)
    assert bag(got) == bag(df.distinct())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and ("BroadcastHashJoin" in plan) == bool(most)
