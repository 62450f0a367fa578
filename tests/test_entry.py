import importlib
import os

import pytest

import __spark_entry__ as entry

from .conftest import DATA


def test_names_and_sql_belong_together():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 60
    for n in (4, 5):
        assert f"p{n}_found" in q


def test_llm_queries_only_where_the_subpackage_is():
    try:
        importlib.import_module("foliospark.llm.queries")
    except ImportError:
        assert not any(k.startswith(("p1_", "p10_")) for k in entry.queries())
    else:
        assert all(any(k.startswith(f"p{n}_") for k in entry.queries()) for n in range(1, 11))


def test_flagship_runs(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test data here")
    assert entry.entry(spark).count() > 0
