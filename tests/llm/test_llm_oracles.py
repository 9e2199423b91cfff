"""The registered queries of the training-data operators on the smallest supplied tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check_oracles import compare, connect
from waykit.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    verdict = compare(spark, con, name, SF_DIR)
    assert verdict == "" if name in queries.ORACLES else verdict.startswith("no oracle")


def test_one_query_per_operator_and_the_pipeline():
    names = list(contract.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
