"""Explicit schemas: raw sources (read as text where the source is text, so
parsing is tolerant and explicit), cleaned tables, the fact table and the
quality report.  Nothing in the library infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, TS = (T.StringType(), T.DoubleType(), T.LongType(),
                  T.IntegerType(), T.TimestampNTZType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- raw sources -----------------------------------------------------------
# CSV sources are read as text; numbers and dates are parsed by the cleaners.
RAW_ORDERS = _struct(("order_id", S), ("order_date", S), ("customer_id", S),
                     ("product_id", S), ("store_id", S), ("quantity", S),
                     ("unit_price", S), ("channel", S))
RAW_PRODUCTS = _struct(("product_id", S), ("product_name", S), ("category", S),
                       ("brand", S), ("cost_price", S), ("sale_price", S))
RAW_STORES = _struct(("store_id", S), ("store_name", S), ("city", S),
                     ("region", S), ("opening_date", S))
# JSON sources carry typed numbers; timestamps are text.
RAW_INVENTORY = _struct(("product_id", S), ("store_id", S), ("stock_qty", L),
                        ("last_update", S))
RAW_REVIEWS = _struct(("review_id", S), ("product_id", S), ("rating", L),
                      ("comment", S), ("review_date", S))
RAW_EVENTS = _struct(("event_id", S), ("product_id", S), ("event_type", S),
                     ("event_ts", S), ("source", S))

RAW = {
    "orders": RAW_ORDERS, "products": RAW_PRODUCTS, "stores": RAW_STORES,
    "inventory": RAW_INVENTORY, "reviews": RAW_REVIEWS, "events": RAW_EVENTS,
}

# --- cleaned tables ----------------------------------------------------------
ORDERS = _struct(("order_id", S), ("order_date", TS), ("customer_id", S),
                 ("product_id", S), ("store_id", S), ("quantity", D),
                 ("unit_price", D), ("channel", S))
PRODUCTS = _struct(("product_id", S), ("product_name", S), ("category", S),
                   ("brand", S), ("cost_price", D), ("sale_price", D))
STORES = _struct(("store_id", S), ("store_name", S), ("city", S),
                 ("region", S), ("opening_date", TS))
INVENTORY = _struct(("product_id", S), ("store_id", S), ("stock_qty", L),
                    ("last_update", TS))
REVIEWS = _struct(("review_id", S), ("product_id", S), ("rating", L),
                  ("comment", S), ("review_date", TS))
EVENTS = _struct(("event_id", S), ("product_id", S), ("event_type", S),
                 ("event_ts", TS), ("source", S))

# --- outputs -----------------------------------------------------------------
FACT_STOCK_RISK = _struct(("product_id", S), ("store_id", S), ("sales_7d", L),
                          ("sales_30d", L), ("avg_rating", D), ("stock_qty", L),
                          ("category", S), ("region", S), ("web_signal", L),
                          ("stockout_risk", I))
AGG_REVIEWS = _struct(("product_id", S), ("avg_rating", D), ("nb_reviews", L),
                      ("last_review_date", TS))
QUALITY_CHECKS = _struct(("dataset", S), ("rows", L), ("columns", L),
                         ("duplicates", L), ("null_order_id", L),
                         ("null_product_id", L), ("null_store_id", L),
                         ("null_review_id", L), ("null_event_id", L))
RUN_LOG = _struct(("run_id", S), ("step", S), ("metric", S), ("value", D))

# Warehouse tables: name -> (schema, primary key, {fk column: (table, column)})
WAREHOUSE = {
    "dim_product": (PRODUCTS, ["product_id"], {}),
    "dim_store": (_struct(("store_id", S), ("store_name", S), ("city", S),
                          ("region", S), ("opening_date", S)), ["store_id"], {}),
    "fact_orders": (_struct(("order_id", S), ("order_date", S), ("customer_id", S),
                            ("product_id", S), ("store_id", S), ("quantity", I),
                            ("unit_price", D), ("channel", S)),
                    ["order_id"],
                    {"product_id": ("dim_product", "product_id"),
                     "store_id": ("dim_store", "store_id")}),
    "fact_inventory": (INVENTORY, ["product_id", "store_id"],
                       {"product_id": ("dim_product", "product_id"),
                        "store_id": ("dim_store", "store_id")}),
    "fact_events": (EVENTS, ["event_id"],
                    {"product_id": ("dim_product", "product_id")}),
    "agg_reviews": (AGG_REVIEWS, ["product_id"],
                    {"product_id": ("dim_product", "product_id")}),
    "fact_stock_risk": (FACT_STOCK_RISK, ["product_id", "store_id"],
                        {"product_id": ("dim_product", "product_id"),
                         "store_id": ("dim_store", "store_id")}),
}
