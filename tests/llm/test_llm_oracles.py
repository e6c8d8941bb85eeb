"""The queries that SQL can express, against DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from check_oracles import compare_all  # noqa: E402

from voltaic.llm.queries import oracle_sql  # noqa: E402


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, sf):
    problems = compare_all(spark, f"/root/testdata/{sf}", list(oracle_sql()), verbose=False)
    assert not {k: v for k, v in problems.items() if v}
