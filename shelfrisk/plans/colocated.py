"""J2-J6 over a co-located layer: sales and stock stored once per (product_id,
store_id), bucketed and sorted by that pair, so that the facts built from them join
without an exchange or a sort.

Only tables of one row per pair are bucketed: a bucket is read by one task, and the
rows of a pair that holds a third of all would be that task's.  Sums and latest
readings are made first, map-side, and then dealt into buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .. import params as P
from ..operators.aggregate import review_features, web_signal
from ..operators.joins import join_stock, join_store, left_join, product_features
from .fact import add_stockout_flag, fill_fact_defaults


def store_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``keys`` (as many buckets
    as the session has shuffle partitions by default), one file a bucket."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
       .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return spark.table(table)


def store_pairs(sales: DataFrame, inventory: DataFrame, root: str, prefix: str, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The pair layer: (sales, stock), each one row per (product_id, store_id)."""
    keys = P.ID_COLUMNS
    return (store_bucketed(sales, f"{prefix}sales", f"{root}/sales", keys, buckets),
            store_bucketed(inventory.select(*keys, "stock_qty"), f"{prefix}stock", f"{root}/stock", keys, buckets))


def fact_from_pairs(sales: DataFrame, stock: DataFrame, products: DataFrame, stores: DataFrame,
                    reviews: DataFrame, events: DataFrame, long_days: int = P.LONG_WINDOW_DAYS) -> DataFrame:
    """D2 from the pair layer and the cleaned small sides."""
    feats = product_features(products, review_features(reviews), web_signal(events, long_days))
    df = left_join(join_stock(sales, stock), feats, "product_id", ["category", "avg_rating", "web_signal"])
    return join_store(df, stores).transform(fill_fact_defaults).transform(add_stockout_flag).select(*P.FACT_COLUMNS)


def forget(spark: SparkSession, prefix: str) -> None:
    """Drop the pair layer's catalog entries; the files stay."""
    for name in ("sales", "stock"):
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")
