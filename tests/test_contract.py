"""The driver's contract: names, columns and the flagship query."""

import __spark_entry__ as entry


def test_registry():
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names) and len(names) >= 25


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["contig", "start", "end"] and out.count() > 0
