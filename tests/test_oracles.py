"""Every registered query against its independent SQL formulation (DuckDB) on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import SF_SMALL  # noqa: E402


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data not present")
def test_all_queries_match_oracles(spark):
    from check_oracles import compare_all

    from voltaic.plans import bindings, oracles
    names = list(bindings.queries())
    problems = compare_all(spark, SF_SMALL, names, verbose=False)
    bad = {k: v for k, v in problems.items() if v}
    assert not bad, bad
    assert set(names) == set(oracles.oracle_sql())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "event_date" in df.columns
