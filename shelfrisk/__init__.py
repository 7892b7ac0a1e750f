"""shelfrisk: stock-out risk analytics as Spark jobs.

Main entry points::

    from shelfrisk import clean_sources, build_fact_stock_risk, run_etl, run_training, run_load
"""

from .plans.etl import clean_sources, fact_from_clean, run_etl
from .plans.fact import build_fact_stock_risk
from .plans.training import run_training
from .plans.warehouse import run_load

__all__ = ["build_fact_stock_risk", "clean_sources", "fact_from_clean", "run_etl",
           "run_load", "run_training"]
