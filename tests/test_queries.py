"""Every registered query with SQL gives the SQL's rows; the others give rows."""

from __future__ import annotations

import pytest

from ledgerspark.page_queries import ORACLES, QUERIES
from tests.compare import differences, oracle

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF).toPandas(), oracle(SF, ORACLES[name])) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
