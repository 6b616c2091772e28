"""All registered queries against their oracles."""

import os

import pytest

from spendmill.verify.compare import differences
from spendmill.verify.registry import oracle_sql, queries

SF_DIR = os.environ.get("SPENDMILL_SF_DIR", "/root/testdata/sf0.001")
NAMES = list(queries())


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    assert differences(queries()[name](spark, SF_DIR), SF_DIR, oracle_sql()[name]) == []
