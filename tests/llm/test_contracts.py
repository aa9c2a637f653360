"""Queries on the small tables against their SQL."""

import pytest

from sparkloom.llm import registry

from ..helpers import SMALL, connection, of_spark, of_sql


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert of_spark(registry.QUERIES[name](spark, SMALL)) == of_sql(connection(), registry.ORACLES[name])


def test_all_operators_are_registered():
    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{i}" for i in range(1, 14)}
