"""Warehouse load (reference entry 3): minimal cleaning (CL7-CL9), then an
idempotent reload of the five tables as one step (K5), declared as typed tables (K6).

As in the reference, the load keeps dimension text as it came (no
normalisation) and loads inventory without the clip / zero-fill the fact
applies (variant ``clip=False``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import tolerant_double, tolerant_int
from ..operators import clean as C
from ..session import tune
from ..sources.reload import current_paths, reload_tables
from ..sources.sinks import create_tables

LOAD_TABLES = ("dim_product", "dim_store", "fact_orders", "fact_inventory", "fact_stock_risk")


def load_tables(raw: dict[str, DataFrame], fact: DataFrame, inventory: DataFrame | None = None) -> dict[str, DataFrame]:
    """The five tables; ``inventory`` is what CL8 made of the raw one, where it was
    stored already, as the fact takes its stock from it too."""
    products = (C.load_by_key(raw["products"], ["product_id"])
                .withColumns({"cost_price": tolerant_double("cost_price"),
                              "sale_price": tolerant_double("sale_price")}))
    orders = (C.load_orders(raw["orders"])
              .withColumns({"quantity": tolerant_int("quantity"),
                            "unit_price": tolerant_double("unit_price")}))
    return {
        "dim_product": products,
        "dim_store": C.load_by_key(raw["stores"], ["store_id"]),
        "fact_orders": orders,
        "fact_inventory": C.load_inventory(raw["inventory"]) if inventory is None else inventory,
        "fact_stock_risk": C.load_by_key(fact, ["product_id", "store_id"]),
    }


def run_load(spark: SparkSession, raw: dict[str, DataFrame], fact: DataFrame, root: str,
             register: bool = False, prefix: str = "", inventory: DataFrame | None = None) -> dict[str, DataFrame]:
    """K5 (+ K6 when ``register``): reload the five tables, read back what is
    current.  Declared tables follow once the whole reload is published."""
    tune(spark)
    tables = reload_tables(load_tables(raw, fact, inventory), root)
    if register:
        create_tables(spark, root, prefix, names=list(LOAD_TABLES), paths=current_paths(spark, root))
    return tables
