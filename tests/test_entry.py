"""The driver contract, and a part of the registered queries beside their SQL twins."""

import importlib.util
from pathlib import Path

import pytest

from workload import compare, oracle, registry

QUICK = ["q_trailing_avg", "q_stage_demand", "q_dim_date", "q_fact_demand", "q_generation_mix", "q_state_changes",
         "q_peak_drivers", "q_incremental_sales", "q_isd_parse"]


@pytest.fixture(scope="module")
def entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", Path(__file__).parents[1] / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_entry_runs(spark, entry_module):
    df = entry_module.entry(spark)
    assert df.columns[:2] == ["balancing_authority", "date"] and df.count() > 0


def test_every_query_of_the_models_has_sql(entry_module):
    missing = set(entry_module.queries()) - set(entry_module.oracle_sql())
    assert not [name for name in missing if name.startswith("q_")]
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, small, name):
    assert compare.differences(spark, compare.connect(small), small, name) == []


def test_registered_names_are_plain():
    assert all(name.startswith("q_") for name in registry.QUERIES)
    assert all(sql.startswith("WITH") for sql in oracle.oracle_sql().values())
