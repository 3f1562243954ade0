"""Every core query that has SQL, side by side with it on the smallest tables; the others must run."""

from __future__ import annotations

import pytest

from quern.queries import ORACLE, QUERIES
from tests.compare import agree


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    agree(QUERIES[name](spark, sf_dir), duck, ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_runs(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns and df.count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
