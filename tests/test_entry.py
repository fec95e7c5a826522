"""Driver contract: entry() yields rows; every oracle key is a registered query."""

import __spark_entry__ as E


def test_entry_has_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "row_count" in df.columns and "target_q99" in df.columns


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
