"""Rows of a small file are dealt over tasks before the work that each of them takes."""

import pytest

from __spark_entry__ import queries


@pytest.mark.parametrize("key", ["f13_similar_names", "n1_contacts", "n1_contact_rejects"])
def test_rows_are_dealt(spark, key):
    assert "Exchange hashpartitioning(xxhash64(" in queries()[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
