"""The operators that SQL can express against their DuckDB SQL."""

import pytest

from playgrid.llm.queries import ORACLE_SQL, QUERIES
from playgrid.oracle.check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, name):
    got = compare(QUERIES[name](spark, SF), ORACLE_SQL[name], duck(SF))
    assert got["match"] and got["spark_rows"], got
