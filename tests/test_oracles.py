"""Every registered query against its DuckDB form on the smallest supplied tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check_oracles import compare, connect
from waykit import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "route_id" and df.count() == 37


def test_contract_holds_without_the_training_data_operators(monkeypatch):
    monkeypatch.setattr(contract, "llm", None)
    monkeypatch.setattr(contract, "pipeline", None)
    assert set(contract.queries()) == set(contract.oracle_sql()) == set(registry.QUERIES)
