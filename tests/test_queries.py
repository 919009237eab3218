"""Every registered query against its SQL on the smallest tables, and what its plan must not contain."""

import os
import re

import pytest

from __spark_entry__ import entry
from checks import ORACLES, QUERIES
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    sql = ORACLES.get(name)
    if sql is None:
        assert df.count() > 0
    else:
        result = compare(df, con, sql)
        # Small tables may leave nothing to report.
        assert result in ("", "no rows")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in physical
    for window in re.findall(r"windowspecdefinition\(([^\n]*)", physical):
        # A partition expression comes before the order expression. One constant
        # series leaves only the order of its chunk counts, a few rows.
        assert not re.match(r"(?!_chunk)\w+#\d+L? (ASC|DESC)", window), window


def test_entry(spark):
    assert entry(spark).count() > 0
