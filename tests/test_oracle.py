"""Every registered query against its SQL counterpart.

The streaming replays are left to ``test_streaming``, which runs the same chains
over several batches.
"""

import __spark_entry__ as contract
import compare
import pytest
from conftest import SF_DIR

from sparkmart.plans import queries as registered

# The queries of the main library; those of subpackages are tested beside them.
QUERIES = {name: contract.queries()[name] for name in registered.QUERIES}
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_query(spark, con, name):
    assert compare.difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
