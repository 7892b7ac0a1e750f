"""The stock-out risk fact table at (product_id, store_id) grain.

Plan shape (one shuffle per input, aggregation before every join):

  orders    -> filter(last 30 d, scalar-subquery anchor) -> partial agg ->
               exchange(product_id, store_id) -> final agg          = sales
  inventory -> partial max(struct) -> exchange(product_id, store_id) = stock
  sales LEFT JOIN stock            (co-partitioned: no extra exchange)
  products + reviews-agg + web-agg stacked, one aggregate per product_id
               (inputs already partitioned by product_id: no exchange)
  pairs LEFT JOIN product features on product_id
  pairs LEFT JOIN stores on store_id
  fill missing -> flag -> fixed column order
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import stockout_flag
from ..operators.aggregate import review_features, sales_two_horizons, web_signal
from ..operators.joins import join_stock, join_store, left_join, product_features


def fill_fact_defaults(df: DataFrame) -> DataFrame:
    """C11 on the fact: missing rating / web signal / stock become 0; category
    and region stay NULL."""
    return df.withColumns({
        "avg_rating": F.coalesce("avg_rating", F.lit(0.0)),
        "web_signal": F.coalesce("web_signal", F.lit(0)).cast("long"),
        "stock_qty": F.coalesce("stock_qty", F.lit(0)).cast("long"),
    })


def add_stockout_flag(df: DataFrame, stock_threshold: int = P.STOCK_THRESHOLD,
                      demand_threshold: int = P.DEMAND_THRESHOLD) -> DataFrame:
    """D1 (applied after the stock fill, so an unknown stock counts as 0)."""
    return df.withColumn(P.LABEL, stockout_flag("stock_qty", "sales_7d",
                                                stock_threshold, demand_threshold))


def build_fact_stock_risk(orders: DataFrame, products: DataFrame, stores: DataFrame,
                          inventory: DataFrame, reviews: DataFrame, events: DataFrame,
                          stock_threshold: int = P.STOCK_THRESHOLD,
                          demand_threshold: int = P.DEMAND_THRESHOLD,
                          short_days: int = P.SHORT_WINDOW_DAYS,
                          long_days: int = P.LONG_WINDOW_DAYS) -> DataFrame:
    """D2 over cleaned inputs (CL1-CL6 outputs)."""
    sales = sales_two_horizons(orders, short_days, long_days)
    pairs = join_stock(sales, inventory)
    feats = product_features(products, review_features(reviews), web_signal(events, long_days))
    df = left_join(pairs, feats, "product_id", ["category", "avg_rating", "web_signal"])
    df = join_store(df, stores)
    return (df.transform(fill_fact_defaults)
              .transform(add_stockout_flag, stock_threshold, demand_threshold)
              .select(*P.FACT_COLUMNS))
