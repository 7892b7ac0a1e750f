"""The analysis statements (Q4-Q5, Q7-Q10) as Spark SQL over the loaded and
declared warehouse tables (K6): what ``plans.marts`` offers on frames."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .. import params as P
from ..sources.reload import current_paths
from ..sources.sinks import create_tables, drop_tables

#: name -> (statement over {orders} and {fact}, its key and its value in the long form)
STATEMENTS = {
    "order_duplicates": ("SELECT order_id, count(*) AS nb FROM {orders} GROUP BY order_id HAVING count(*) > 1",
                         "order_id", "nb"),
    "order_null_counts": ("SELECT c AS column, count_if(v IS NULL) AS n FROM {orders} LATERAL VIEW stack(3, "
                          "'product_id', product_id, 'store_id', store_id, 'order_date', CAST(order_date AS STRING)) s AS c, v "
                          "GROUP BY c", "column", "n"),
    "risk_distribution": (f"SELECT {P.LABEL}, count(*) AS nb FROM {{fact}} GROUP BY {P.LABEL} ORDER BY {P.LABEL}",
                          P.LABEL, "nb"),
    "fact_duplicates": ("SELECT product_id, store_id, count(*) AS nb FROM {fact} GROUP BY product_id, store_id "
                        "HAVING count(*) > 1", "concat_ws('|', product_id, store_id)", "nb"),
    # decimal arithmetic: halves go up, as on NUMERIC
    "region_avg_sales": ("SELECT region, round(CAST(sum(sales_30d) AS DECIMAL(28, 0)) / count(sales_30d), 2) AS avg_sales_30d "
                         "FROM {fact} GROUP BY region ORDER BY avg_sales_30d DESC", "region", "avg_sales_30d"),
    "at_risk_rows": (f"SELECT product_id, store_id, stock_qty, sales_7d, {P.LABEL} FROM {{fact}} WHERE {P.LABEL} = 1 "
                     "ORDER BY sales_7d DESC, stock_qty ASC, product_id, store_id",
                     "concat_ws('|', product_id, store_id, stock_qty)", "sales_7d"),
}


@contextmanager
def declared(spark: SparkSession, root: str) -> Iterator[str]:
    """The current tables of a reload, declared under a prefix of their own
    while the block runs, and forgotten after it."""
    prefix = f"wh_{uuid.uuid4().hex[:10]}_"
    paths = current_paths(spark, root)
    tables = create_tables(spark, root, prefix, names=list(paths), paths=paths)
    try:
        yield prefix
    finally:
        drop_tables(spark, tables)


def statement_sql(name: str, prefix: str = "") -> str:
    return STATEMENTS[name][0].format(orders=f"{prefix}fact_orders", fact=f"{prefix}fact_stock_risk")


def run_statement(spark: SparkSession, name: str, prefix: str = "") -> DataFrame:
    """One statement by name, in its own columns and order."""
    return spark.sql(statement_sql(name, prefix))


def run_statements(spark: SparkSession, prefix: str = "") -> DataFrame:
    """All statements in one frame: (statement, key, value); a null key stays null."""
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{name}' AS statement, CAST({key} AS STRING) AS key, CAST({value} AS DOUBLE) AS value "
        f"FROM ({statement_sql(name, prefix)})" for name, (_, key, value) in STATEMENTS.items()))
