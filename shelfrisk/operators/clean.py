"""Projections, filters and cleaners (C1-C18, CL1-CL9).

Every function is DataFrame -> DataFrame and composes with ``df.transform``.
Keep-first / keep-latest are grouped aggregates over a struct (partial
aggregation map-side, no window; Spark sorts each map task's rows for it), so a key holding a third of all
rows is pre-reduced in every map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions import clip_lower, fill_default, strip_lower, tolerant_double, tolerant_timestamp


# --- C1 / C2 / C3: dedupe ----------------------------------------------------

def dedupe_exact(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows, lazily, so that filters and column pruning
    reach below it.  Where the whole table is written, ``dedupe_exact_by_hash``
    shuffles less."""
    return df.distinct()


def _pick_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                  pick) -> DataFrame:
    first = list(dict.fromkeys(c for c in order_by if c not in keys))
    # remaining columns close the ordering, so ties resolve the same way on
    # every run and partitioning; each column is carried once
    rest = [c for c in df.columns if c not in keys and c not in first]
    packed = F.struct(*[F.col(c) for c in [*first, *rest]]).alias("_pick")
    out = df.groupBy(*keys).agg(pick(packed).alias("_pick"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_pick.{c}").alias(c)
                        for c in df.columns])


def dedupe_by_key_first(df: DataFrame, keys: Sequence[str],
                        order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, the smallest by ``order_by`` then by the remaining
    columns.  (File order, the reference's notion of first, does not exist in
    a distributed read; the ordering is explicit instead.)"""
    return _pick_per_key(df, keys, order_by, F.min)


def latest_per_key(df: DataFrame, keys: Sequence[str],
                   order_by: Sequence[str]) -> DataFrame:
    """One row per key, the largest by ``order_by`` (e.g. the timestamp),
    ties broken by the remaining columns."""
    return _pick_per_key(df, keys, order_by, F.max)


# --- C4 / C5: tolerant parse ---------------------------------------------------

def parse_timestamps(df: DataFrame, column: str,
                     formats: Sequence[str] = (P.ISO_DATE,)) -> DataFrame:
    """C4: text is parsed with the first matching format (else NULL); a column
    that is already a date/timestamp is only normalised to timestamp_ntz."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(column, tolerant_timestamp(column, formats))
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def parse_doubles(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """C5 (double)."""
    return df.withColumns({c: tolerant_double(c) for c in columns})


# --- C6-C9: row filters ------------------------------------------------------

def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """C6."""
    return df.dropna(subset=list(keys))


def filter_positive(df: DataFrame, column: str) -> DataFrame:
    """Strictly positive; NULL fails."""
    return df.filter(F.col(column) > 0)


def filter_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Both ends inclusive; NULL fails."""
    return df.filter(F.col(column).between(low, high))


def filter_membership(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """C9."""
    return df.filter(F.col(column).isin(list(values)))


# --- C10-C17: column operators ---------------------------------------------

def normalize_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strip + lower on the listed columns that exist (one projection)."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: strip_lower(c) for c in present}) if present else df


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """C11."""
    return df.withColumns({c: fill_default(c, v) for c, v in defaults.items()})


def clip_columns(df: DataFrame, columns: Iterable[str], lower=0) -> DataFrame:
    """C12."""
    return df.withColumns({c: clip_lower(c, lower) for c in columns})


# --- CL1-CL6: ETL cleaners ---------------------------------------------------

def clean_orders(df: DataFrame, formats: Sequence[str] = (P.ISO_DATE,),
                 dedupe: Callable[[DataFrame], DataFrame] = dedupe_exact) -> DataFrame:
    """CL1: C1 (``dedupe``) -> C4 -> C5 x2 -> C6 -> C7.  ``formats=(ISO, day-first)``
    repairs the day-first dates the default silently drops.  The quantity keeps
    its fraction; sums of it are cast."""
    return (df.transform(dedupe)
             .transform(parse_timestamps, "order_date", formats)
             .withColumns({"quantity": tolerant_double("quantity"),
                           "unit_price": tolerant_double("unit_price")})
             .transform(drop_null_keys, ["order_id", "product_id", "store_id", "order_date"])
             .transform(filter_positive, "quantity"))


def clean_products(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """CL2: C2(product_id) -> C5 x2 -> C10 -> C6."""
    return (df.transform(dedupe_by_key_first, ["product_id"], order_by)
              .transform(parse_doubles, ["cost_price", "sale_price"])
              .transform(normalize_text, ["category", "brand", "product_name"])
              .transform(drop_null_keys, ["product_id"]))


def clean_stores(df: DataFrame, formats: Sequence[str] = (P.ISO_DATE,),
                 order_by: Sequence[str] = ()) -> DataFrame:
    """CL3: C2(store_id) -> C4 -> C10 -> C6."""
    return (df.transform(dedupe_by_key_first, ["store_id"], order_by)
              .transform(parse_timestamps, "opening_date", formats)
              .transform(normalize_text, ["store_name", "city", "region"])
              .transform(drop_null_keys, ["store_id"]))


INVENTORY_TS_FORMATS = (P.ISO_DATETIME, "yyyy-MM-dd HH:mm:ss", P.ISO_DATE)


def clean_inventory(df: DataFrame, formats: Sequence[str] = INVENTORY_TS_FORMATS,
                    clip: bool = True) -> DataFrame:
    """CL4 (clip=True): C1 -> C5 -> C4 -> C6 -> C11 -> C12 -> C3.
    Latest stock per (product_id, store_id) by last_update; ties keep the
    larger stock.  C1 is subsumed by C3 (exact copies fall in the same key
    group and are identical picks), so it costs no shuffle of its own."""
    out = (df.withColumn("stock_qty", F.col("stock_qty").try_cast("double").try_cast("long"))
             .transform(parse_timestamps, "last_update", formats)
             .transform(drop_null_keys, ["product_id", "store_id", "last_update"]))
    if clip:
        out = fill_stock(out)
    return out.transform(latest_per_key, ["product_id", "store_id"],
                         ["last_update", "stock_qty"])


def fill_stock(df: DataFrame) -> DataFrame:
    """C11 -> C12 on the stock.  Both keep the order of stocks (NULL is the least
    and becomes 0, as all below 0 do), so where a row is nothing but its key, stock
    and time, they may follow C3 as well as precede it: ``fill_stock`` of the loaded
    inventory (CL8) is the cleaned one (CL4)."""
    return df.withColumn("stock_qty", clip_lower(fill_default("stock_qty", 0), 0))


def clean_reviews(df: DataFrame, formats: Sequence[str] = (P.ISO_DATE,),
                  low: int = P.RATING_MIN, high: int = P.RATING_MAX,
                  order_by: Sequence[str] = ()) -> DataFrame:
    """CL5: C2(review_id) -> C4 -> C5 -> C8 -> C6 (NULL rating fails C8)."""
    return (df.transform(dedupe_by_key_first, ["review_id"], order_by)
              .transform(parse_timestamps, "review_date", formats)
              .withColumn("rating", F.col("rating").try_cast("double").try_cast("long"))
              .transform(filter_range, "rating", low, high)
              .transform(drop_null_keys, ["product_id", "rating"]))


EVENT_TS_FORMATS = (P.ISO_DATETIME, "yyyy-MM-dd HH:mm:ss", P.ISO_DATE)


def clean_events(df: DataFrame, valid_types: Iterable[str] = P.VALID_EVENT_TYPES,
                 formats: Sequence[str] = EVENT_TS_FORMATS,
                 order_by: Sequence[str] = ()) -> DataFrame:
    """CL6: C2(event_id) -> C4 -> C10 -> C9 -> C6."""
    return (df.transform(dedupe_by_key_first, ["event_id"], order_by)
              .transform(parse_timestamps, "event_ts", formats)
              .transform(normalize_text, ["event_type", "source"])
              .transform(filter_membership, "event_type", valid_types)
              .transform(drop_null_keys, ["event_id", "product_id", "event_ts"]))


# --- CL7-CL9: warehouse-load cleaners ---------------------------------------

def load_orders(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """CL7: C1 -> C2(order_id); dates stay text, no filter.  C1 is subsumed by
    C2 (exact copies share the key and are the same pick): one shuffle."""
    return df.transform(dedupe_by_key_first, ["order_id"], order_by)


def load_inventory(df: DataFrame, formats: Sequence[str] = INVENTORY_TS_FORMATS) -> DataFrame:
    """CL8: C4 -> C6 -> C3; stock is neither filled nor clipped."""
    return clean_inventory(df, formats, clip=False)


def load_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """CL9: dimension / fact load, one row per key, keep first."""
    return dedupe_by_key_first(df, keys, order_by)
