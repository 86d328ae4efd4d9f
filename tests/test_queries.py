"""Every registered query against its SQL on the smallest test set."""

import pytest

import __spark_entry__ as entry
from lorewright.plans import registry

from .oracle import differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, name):
    same, ours, theirs = differences(registry.queries()[name](spark, SF), registry.oracle_sql()[name], SF)
    assert same and not ours and not theirs, (list(ours)[:2], list(theirs)[:2])


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "num_fragmentos", "quality", "hay_ejemplo"] and df.count() == 200
    assert set(entry.oracle_sql()) <= set(entry.queries())
