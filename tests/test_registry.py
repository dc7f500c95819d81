import os
import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import database, difference

SF = "/root/testdata/sf0.001"
QUICK = [
    "json_flatten", "folder_union", "alias_project", "coerce_numeric", "keyword_filter", "measure_vocab", "id_lookup",
    "dup_keys", "missing_pattern", "pivot_mean", "pivot_strict", "outer_panel", "equal_weight_index", "scatter_bins",
    "ols_multi", "stratified_slopes", "rubin_pool", "ols_wide", "fit_status", "pool_partial", "delimited_read", "folder_report",
    "optional_rule", "sorted_sink", "schema_tools", "resolved_only", "source_class",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def test_every_sql_twin_has_a_query():
    panel_queries = {q for q in queries() if q != "pipeline" and not re.match(r"op\d+_", q)}
    assert set(oracle_sql()) <= set(queries()) and panel_queries - set(oracle_sql()) == {"mice_pmm"}


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["unit", "period", "index"] and df.filter("index is not null").count() >= 10


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, name):
    assert difference(spark, database(SF), SF, name) is None


def test_filters_and_columns_reach_the_scan(spark):
    plan = queries()["period_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "o_orderpriority" not in plan
