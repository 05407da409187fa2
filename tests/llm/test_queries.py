"""The operators' queries: those that SQL can express against their statements."""

import pytest

import __spark_entry__ as entry
from faremill.llm import queries
from verify import SAME, compare, connect

FOLDER = "/root/testdata/sf0.001"
#: Compared with plain versions, a library or held-out rows by the other tests of this folder.
NO_STATEMENT = {
    "op1_pieces",
    "op2_class_model",
    "op3_secrets",
    "op6_sentence_spans",
    "op7_byte_cnn",
    "op8_personal_data",
    "op9_near_duplicates",
    "op10_page_text",
    "op11_spelling_variants",
    "op13_sequence_packing",
    "pipeline",
}


def test_queries_without_a_statement_are_these():
    assert set(queries.queries()) - set(queries.oracle_sql()) == NO_STATEMENT
    assert set(queries.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_statement(spark, name):
    state, note = compare(spark, connect(FOLDER), FOLDER, name)
    assert state == SAME, note
