"""Every registered query against its SQL on the sf0.01 tables."""

import pytest
from compare import compare

import __spark_entry__ as entry_module
from finloom.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


# One row per table, or per partition of a numbered frame, meets in one task here.
FEW_ROWS_TOGETHER = {"load_count", "not_in_nulls", "digest_text", "article_digest_text", "mail_text", "fanout_groups"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "SinglePartition" not in plan or name in FEW_ROWS_TOGETHER
    got = df.toPandas()
    assert compare(got, duck.execute(ORACLES[name]).df()) == ""


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
