"""Analysis statements (Q2-Q10) and chart aggregates (V1-V3) over the fact
and warehouse tables.  Each returns a DataFrame; the chart picture is not the
work, the aggregate is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import round_half_up_ratio
from ..operators.aggregate import having_duplicates, null_counts, value_counts


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Q2: (table_name, rows), one aggregate per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` rows by a total key order (top-k, no full
    sort: TakeOrderedAndProject)."""
    return df.orderBy(*order_by).limit(n)


def table_previews(tables: dict[str, tuple[DataFrame, Sequence[str]]], n: int = 5) -> DataFrame:
    """Q3: ``n`` rows of each table: (table_name, row_key, row as JSON, nulls kept)."""
    parts = []
    for name, (df, keys) in tables.items():
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        parts.append(preview(df, n, keys).select(
            F.lit(name).alias("table_name"), key.alias("row_key"),
            F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns]),
                      {"ignoreNullFields": "false"}).alias("row")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def order_duplicates(orders: DataFrame) -> DataFrame:
    """Q4: order ids occurring more than once."""
    return having_duplicates(orders, ["order_id"], "nb")


def order_null_counts(orders: DataFrame) -> DataFrame:
    """Q5: NULL product_id / store_id / order_date, one pass."""
    return null_counts(orders, ["product_id", "store_id", "order_date"])


def risk_distribution(fact: DataFrame) -> DataFrame:
    """Q7: rows per risk class, ordered by class."""
    return value_counts(fact, P.LABEL, dropna=False, alias="nb").orderBy(P.LABEL)


def fact_duplicates(fact: DataFrame) -> DataFrame:
    """Q8: duplicate grain keys (empty when the grain holds)."""
    return having_duplicates(fact, P.ID_COLUMNS, "nb")


def region_avg_sales(fact: DataFrame) -> DataFrame:
    """Q9: ROUND(AVG(sales_30d), 2) per region (NULL region is a group),
    highest first.  Rounding is exact decimal half-up, as on NUMERIC."""
    agg = fact.groupBy("region").agg(F.sum("sales_30d").alias("_s"), F.count("sales_30d").alias("_n"))
    return (agg.select("region", round_half_up_ratio("_s", "_n", 2).alias("avg_sales_30d"))
               .orderBy(F.desc("avg_sales_30d")))


def at_risk_rows(fact: DataFrame) -> DataFrame:
    """Q10: flagged rows, hottest demand first, then lowest stock.  The grain
    key closes the order: the output order is total, and the range
    partitioning of the sort can split rows that tie on (sales, stock)."""
    return (fact.filter(F.col(P.LABEL) == 1)
                .select("product_id", "store_id", "stock_qty", "sales_7d", P.LABEL)
                .orderBy(F.desc("sales_7d"), F.asc("stock_qty"), "product_id", "store_id"))


def chart_risk(fact: DataFrame) -> DataFrame:
    """V1: bar heights of the risk chart, largest first (NULL dropped)."""
    return value_counts(fact, P.LABEL, dropna=True, alias="count").orderBy(F.desc("count"))


def chart_points(fact: DataFrame) -> DataFrame:
    """V2: the (sales_7d, stock_qty) scatter as distinct points with
    multiplicity, so the output is bounded by the value grid, not the rows."""
    return fact.groupBy("sales_7d", "stock_qty").agg(F.count(F.lit(1)).alias("n"))


def chart_region(fact: DataFrame) -> DataFrame:
    """V3: mean sales_30d per known region, ascending."""
    return (fact.filter(F.col("region").isNotNull()).groupBy("region")
                .agg(F.avg(F.col("sales_30d").cast("double")).alias("mean_sales_30d"))
                .orderBy("mean_sales_30d"))
