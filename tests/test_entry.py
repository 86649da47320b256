"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    assert df.count() > 0
    assert "customer_id" in df.columns and "rank" in df.columns


def test_queries_and_oracles_line_up():
    mod = _entry_module()
    q, o = mod.queries(), mod.oracle_sql()
    assert len(q) >= 40
    assert set(o) <= set(q)
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip() for s in o.values())
