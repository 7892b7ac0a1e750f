"""Joins (J1-J7).

All joins are equi-joins on string keys.  Strategy is left to the planner:
with AQE on, a side whose *materialised* shuffle output is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` is broadcast at run time,
anything larger stays a sort-merge join, and a hot key on the preserved side
of a left join is split by AQE's skew-join handling.  No side is broadcast by
hint unless its size is bounded by construction.
"""

from __future__ import annotations

from functools import reduce

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregate import sales_outer_merge  # noqa: F401  (J1 lives with A4)


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str] | str,
              columns: Sequence[str]) -> DataFrame:
    """Left join that brings ``columns`` of ``right`` (unique per key)
    onto every row of ``left``; the right side is pruned to key + columns."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return left.join(right.select(*keys, *columns), keys, "left")


def join_stock(sales: DataFrame, inventory: DataFrame) -> DataFrame:
    """Latest stock onto each sold (product, store) pair.  Both sides are
    one row per (product_id, store_id) and hash-partitioned on that pair by
    their own aggregations, so the join adds no exchange."""
    return left_join(sales, inventory, ["product_id", "store_id"], ["stock_qty"])


def join_product(df: DataFrame, products: DataFrame) -> DataFrame:
    """Product category."""
    return left_join(df, products, "product_id", ["category"])


def join_store(df: DataFrame, stores: DataFrame) -> DataFrame:
    """Store region."""
    return left_join(df, stores, "store_id", ["region"])


def join_reviews(df: DataFrame, review_feats: DataFrame) -> DataFrame:
    """Mean rating."""
    return left_join(df, review_feats, "product_id", ["avg_rating"])


def join_web(df: DataFrame, web: DataFrame) -> DataFrame:
    """Web signal."""
    return left_join(df, web, "product_id", ["web_signal"])


def product_features(products: DataFrame, review_feats: DataFrame,
                     web: DataFrame) -> DataFrame:
    """J3 + J5 + J6 fused: every product-keyed side is one row per product,
    so stacking them and taking one value per column and product gives their
    outer join with a single exchange (a chain of full outer joins would
    re-shuffle after each join, as the coalesced key loses the partitioning).
    The large pair-level table then crosses a single product_id join."""
    none_s, none_d, none_l = (F.lit(None).cast(t) for t in ("string", "double", "long"))
    stacked = (products.select("product_id", F.col("category"), none_d.alias("avg_rating"),
                               none_l.alias("web_signal"))
               .unionByName(review_feats.select("product_id", none_s.alias("category"),
                                                F.col("avg_rating"), none_l.alias("web_signal")))
               .unionByName(web.select("product_id", none_s.alias("category"),
                                       none_d.alias("avg_rating"), F.col("web_signal"))))
    return stacked.groupBy("product_id").agg(F.max("category").alias("category"),
                                             F.max("avg_rating").alias("avg_rating"),
                                             F.max("web_signal").alias("web_signal"))


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str,
               name: str | None = None) -> DataFrame:
    """Rows of ``child`` whose non-NULL ``fk`` has no ``pk`` in ``parent``.

    The child is first reduced to (fk, rows) by partial aggregation, so a hot
    key never reaches the anti join as many rows.  Output: one row per
    orphan key with its row count."""
    keys = (child.filter(F.col(fk).isNotNull())
                 .groupBy(fk).agg(F.count(F.lit(1)).alias("orphan_rows")))
    parents = parent.select(F.col(pk).alias(fk)).filter(F.col(fk).isNotNull())
    out = keys.join(parents, fk, "left_anti")
    return out.select(F.lit(name or fk).alias("fk_name"),
                      F.col(fk).cast("string").alias("orphan_key"), "orphan_rows")


def fk_summary(orphans: DataFrame) -> DataFrame:
    """J7 summary: orphan keys and orphan rows per constraint."""
    return orphans.groupBy("fk_name").agg(
        F.count(F.lit(1)).alias("orphan_keys"),
        F.sum("orphan_rows").cast("long").alias("orphan_rows"))


def fk_report(tables: dict[str, DataFrame], warehouse: dict) -> DataFrame:
    """J7 for every declared key at once: orphan keys and rows by constraint.
    Each child is read once and reduced to (constraint, key, rows) before one
    join with the parents' keys."""
    def keys(df, refs):
        refs = F.array(*(F.struct(F.lit(name).alias("fk_name"), F.lit(parent).alias("parent"),
                                  F.col(column).cast("string").alias("key")) for name, parent, column in refs))
        return df.select(F.inline(refs)).filter(F.col("key").isNotNull())

    children = [keys(tables[t], [(f"{t}.{c}", parent, c) for c, (parent, _) in fks.items()])
                for t, (_, _, fks) in warehouse.items() if fks]
    parents = {ref for _, _, fks in warehouse.values() for ref in fks.values()}
    known = [tables[t].select(F.lit(t).alias("parent"), F.col(c).cast("string").alias("key")) for t, c in sorted(parents)]
    found = reduce(DataFrame.unionByName, children).groupBy("fk_name", "parent", "key").agg(F.count("*").alias("n"))
    known = reduce(DataFrame.unionByName, known).distinct().withColumn("known", F.lit(True))
    orphan = F.col("known").isNull()
    return (found.join(known, ["parent", "key"], "left").groupBy("fk_name")
            .agg(F.count_if(orphan).alias("orphan_keys"),
                 F.sum(F.when(orphan, F.col("n")).otherwise(0)).cast("long").alias("orphan_rows")))
