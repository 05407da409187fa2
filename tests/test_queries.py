"""Every registered query against its SQL statement; the queries of ``llm`` have tests of their own."""

import pytest

import __spark_entry__ as entry
import oracle
from verify import SAME, compare, connect

FOLDER = "/root/testdata/sf0.001"
OTHERS = set(entry.llm.queries()) if entry.llm else set()
NAMES = [name for name in entry.queries() if name not in OTHERS]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_statement(spark, con, name):
    state, note = compare(spark, con, FOLDER, name)
    assert state == SAME, note


def test_every_query_has_a_statement():
    assert set(NAMES) == set(oracle.statements())
    assert set(oracle.statements()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
