"""Every query runs on a whole table, and equals its SQL where there is one."""

import pytest

from headway.llm import queries
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF)
    if name in queries.ORACLES:
        assert differences(df, connect(SF), queries.ORACLES[name]) == []
    else:
        assert df.count() > 0
