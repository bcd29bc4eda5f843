"""Every core query with a SQL text, against DuckDB on the whole tables; every other one runs."""

from __future__ import annotations

import pytest

from brindle import plans
from brindle.registry import CORE
from tests.oracle import compare

plans.load()


@pytest.mark.parametrize("name", sorted(CORE.oracles))
def test_query_equals_sql(name, spark, sf_dir):
    compare(name, CORE.queries[name], CORE.oracles[name], spark, sf_dir)


@pytest.mark.parametrize("name", sorted(set(CORE.queries) - set(CORE.oracles)))
def test_query_runs(name, spark, sf_dir):
    assert CORE.queries[name](spark, sf_dir).count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len([n for n in CORE.oracles]) >= 40
