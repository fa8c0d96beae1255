"""Every registered query against its SQL, and what no plan may contain."""

from __future__ import annotations

import oracle
import pytest

from rowforge.operators import partition_balance
from rowforge.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert oracle.difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_and_no_pairing_of_all_rows(spark, sf_dir, plan_of, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_entry(spark):
    import __spark_entry__ as entry_module

    result = entry_module.entry(spark)
    assert result.count() > 0
    assert entry_module.queries().keys() >= QUERIES.keys()
    assert entry_module.oracle_sql().items() >= ORACLES.items()


def test_partition_balance_counts_all_rows(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    balance = partition_balance(lines.repartition(6)).collect()
    assert len(balance) == 6
    assert sum(r["rows"] for r in balance) == lines.count()
