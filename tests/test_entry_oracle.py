"""Contract + every registered query against its DuckDB oracle on sf0.001."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from shelfrisk import params as P
from shelfrisk import registry

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(f"{SF}/lineitem.parquet"), reason="no driver data")


def test_contract_keys():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(registry.QUERIES) - set(sql) == {"train_forest"}


@needs_data
def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == P.FACT_COLUMNS
    assert df.count() == 74 and df.filter("stockout_risk = 1").count() == 2


@needs_data
@pytest.mark.parametrize("key", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, key):
    from tools.compare_oracle import compare
    res = compare(spark, SF, [key])[key]
    assert "error" not in res, res
    if res["oracle"]:
        assert res["cols_match"], res
        assert res["spark_rows"] == res["oracle_rows"], res
        assert res["hash_match"], res
