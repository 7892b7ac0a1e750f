"""Adapters from the driver's star-schema tables to the six retail sources.

Two flavours, both pure projections / joins of the whole driver tables:

* ``typed_*``: clean typed columns (what a curated lakehouse table holds).
* ``raw_*``: the same rows as the text a CSV / JSON export would carry, with
  dirt injected by deterministic row rules, so every cleaning rule has real
  work on every row of the table.  The rules only decide *how* a row is
  dirtied; no row is ever left out.

Dirt rules (fixed; any SQL engine can reproduce them with the same modulo
expressions, which is how the oracle checks the cleaners):
  orders   : l_orderkey % 17 = 0 -> order_date as dd/MM/yyyy text
             l_orderkey % 23 = 0 -> negative quantity
             l_orderkey % 31 = 0 -> empty quantity
             l_orderkey % 37 = 0 -> zero quantity
             l_orderkey % 29 = 0 -> NULL store_id
             l_orderkey % 97 = 0 -> row emitted twice (exact duplicate)
  products : p_partkey % 7 = 0  -> category padded and upper-cased
             p_partkey % 11 = 0 -> category wrapped in tab / newline
             p_partkey % 13 = 0 -> brand padded and upper-cased
             p_partkey % 41 = 0 -> second row for the key, name + ' (copy)'
  stores   : s_suppkey % 3 = 0  -> city lower-cased + trailing blanks
             s_suppkey % 4 = 0  -> region lower-cased + leading blank
             s_suppkey % 17 = 0 -> opening_date as dd/MM/yyyy
             s_suppkey % 19 = 0 -> second row for the key, name + ' (copy)'
  inventory: l_orderkey % 19 = 0 -> NULL stock_qty
             l_orderkey % 29 = 0 -> NULL store_id
             l_orderkey % 43 = 0 -> unparsable last_update
             l_orderkey % 97 = 0 -> exact duplicate
  reviews  : event_id % 37 = 0 -> NULL rating
             event_id % 89 = 0 -> second row for the key, comment + ' (edited)'
  events   : event_id % 7 = 0  -> event_type padded and upper-cased
             event_id % 53 = 0 -> unparsable event_ts
             event_id % 3 = 0  -> source ' App ' (else 'web')
             event_id % 89 = 0 -> second row for the key, source 'replay'
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _every(c: str, n: int) -> Column:
    return (F.col(c) % n) == 0


def _copies(c: str, n: int) -> Column:
    """0 for every row, plus a second row (1) when ``c % n = 0``: duplicates
    are emitted in the same pass as the originals (no second scan)."""
    return F.explode(F.when(_every(c, n), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def _for_copy(copy: Column, original: Column) -> Column:
    return F.when(F.col("_copy") == 1, copy).otherwise(original)


def _order_id() -> Column:
    return F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber"))


def _opening_date() -> Column:
    k = F.col("s_suppkey")
    return F.make_date((F.lit(1990) + k % 30).cast("int"), (F.lit(1) + k % 12).cast("int"),
                       (F.lit(1) + k % 28).cast("int"))


# --- typed ---------------------------------------------------------------

def typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                              _s("o_custkey").alias("customer_id"))
    return table(spark, sf_dir, "lineitem").join(o, "l_orderkey", "left").select(
        _order_id().alias("order_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("order_date"),
        "customer_id",
        _s("l_partkey").alias("product_id"),
        _s("l_suppkey").alias("store_id"),
        F.col("l_quantity").alias("quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
        F.col("l_returnflag").alias("channel"),
    )


def typed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _s("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        F.lit(None).cast("double").alias("cost_price"),
        F.col("p_retailprice").alias("sale_price"))


def _supplier_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"),
                                              "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return s.join(n, "s_nationkey", "left").join(r, "n_regionkey", "left")


def typed_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supplier_geo(spark, sf_dir).select(
        _s("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"),
        F.col("n_name").alias("city"), F.col("r_name").alias("region"),
        _opening_date().cast("timestamp_ntz").alias("opening_date"))


def typed_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _s("l_partkey").alias("product_id"), _s("l_suppkey").alias("store_id"),
        (F.col("l_quantity").try_cast("long") - 5).alias("stock_qty"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("last_update"))


def typed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        _s("event_id").alias("review_id"), _s("user_id").alias("product_id"),
        F.floor("value").cast("long").alias("rating"), F.col("props").alias("comment"),
        F.col("ts").cast("timestamp_ntz").alias("review_date"))


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        _s("event_id").alias("event_id"), _s("user_id").alias("product_id"),
        F.col("event_type"), F.col("ts").cast("timestamp_ntz").alias("event_ts"),
        F.lit("web").alias("source"))


def typed_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": typed_orders(spark, sf_dir), "products": typed_products(spark, sf_dir),
        "stores": typed_stores(spark, sf_dir), "inventory": typed_inventory(spark, sf_dir),
        "reviews": typed_reviews(spark, sf_dir), "events": typed_events(spark, sf_dir),
    }


# --- raw (text, dirt injected) ------------------------------------------

def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    li = li.join(o, "l_orderkey", "left")
    qty = F.col("l_quantity").cast("int")
    rows = li.select(
        _order_id().alias("order_id"),
        F.when(_every("l_orderkey", 17), F.date_format("l_shipdate", "dd/MM/yyyy"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("order_date"),
        _s("o_custkey").alias("customer_id"),
        _s("l_partkey").alias("product_id"),
        F.when(_every("l_orderkey", 29), F.lit(None).cast("string"))
         .otherwise(_s("l_suppkey")).alias("store_id"),
        F.when(_every("l_orderkey", 23), _s(-qty))
         .when(_every("l_orderkey", 31), F.lit(""))
         .when(_every("l_orderkey", 37), F.lit("0"))
         .otherwise(_s(qty)).alias("quantity"),
        _s(F.try_divide("l_extendedprice", "l_quantity")).alias("unit_price"),
        F.col("l_returnflag").alias("channel"),
        _copies("l_orderkey", 97).alias("_copy"),
    )
    return rows.drop("_copy")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    rows = p.select(
        _s("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.when(_every("p_partkey", 7), F.concat(F.lit("  "), F.upper("p_type"), F.lit(" ")))
         .when(_every("p_partkey", 11), F.concat(F.lit("\t"), F.col("p_type"), F.lit("\n")))
         .otherwise(F.col("p_type")).alias("category"),
        F.when(_every("p_partkey", 13), F.concat(F.lit(" "), F.upper("p_brand")))
         .otherwise(F.col("p_brand")).alias("brand"),
        F.lit(None).cast("string").alias("cost_price"),
        _s("p_retailprice").alias("sale_price"),
        _copies("p_partkey", 41).alias("_copy"),
    )
    return rows.withColumn("product_name", _for_copy(
        F.concat("product_name", F.lit(" (copy)")), F.col("product_name"))).drop("_copy")


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _supplier_geo(spark, sf_dir)
    rows = g.select(
        _s("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"),
        F.when(_every("s_suppkey", 3), F.concat(F.lower("n_name"), F.lit("  ")))
         .otherwise(F.col("n_name")).alias("city"),
        F.when(_every("s_suppkey", 4), F.concat(F.lit(" "), F.lower("r_name")))
         .otherwise(F.col("r_name")).alias("region"),
        F.when(_every("s_suppkey", 17), F.date_format(_opening_date(), "dd/MM/yyyy"))
         .otherwise(F.date_format(_opening_date(), "yyyy-MM-dd")).alias("opening_date"),
        _copies("s_suppkey", 19).alias("_copy"),
    )
    return rows.withColumn("store_name", _for_copy(
        F.concat("store_name", F.lit(" (copy)")), F.col("store_name"))).drop("_copy")


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(
        _s("l_partkey").alias("product_id"),
        F.when(_every("l_orderkey", 29), F.lit(None).cast("string"))
         .otherwise(_s("l_suppkey")).alias("store_id"),
        F.when(_every("l_orderkey", 19), F.lit(None).cast("long"))
         .otherwise(F.col("l_quantity").try_cast("long") - 5).alias("stock_qty"),
        F.when(_every("l_orderkey", 43), F.lit("unknown"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("last_update"),
        _copies("l_orderkey", 97).alias("_copy"),
    )
    return rows.drop("_copy")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    rows = e.select(
        _s("event_id").alias("review_id"), _s("user_id").alias("product_id"),
        F.when(_every("event_id", 37), F.lit(None).cast("long"))
         .otherwise(F.floor("value").cast("long")).alias("rating"),
        F.col("props").alias("comment"),
        F.date_format("ts", "yyyy-MM-dd").alias("review_date"),
        _copies("event_id", 89).alias("_copy"),
    )
    return rows.withColumn("comment", _for_copy(
        F.concat("comment", F.lit(" (edited)")), F.col("comment"))).drop("_copy")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    rows = e.select(
        _s("event_id").alias("event_id"), _s("user_id").alias("product_id"),
        F.when(_every("event_id", 7), F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")))
         .otherwise(F.col("event_type")).alias("event_type"),
        F.when(_every("event_id", 53), F.lit("not a date"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("event_ts"),
        F.when(_every("event_id", 3), F.lit(" App ")).otherwise(F.lit("web")).alias("source"),
        _copies("event_id", 89).alias("_copy"),
    )
    return rows.withColumn("source", _for_copy(F.lit("replay"), F.col("source"))).drop("_copy")


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": raw_orders(spark, sf_dir), "products": raw_products(spark, sf_dir),
        "stores": raw_stores(spark, sf_dir), "inventory": raw_inventory(spark, sf_dir),
        "reviews": raw_reviews(spark, sf_dir), "events": raw_events(spark, sf_dir),
    }
