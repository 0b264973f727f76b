"""Driver contract: entry(), queries(), oracle_sql()."""

import importlib.util
import os

from conftest import ROOT


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = _entry()
    df = mod.entry(spark)
    assert df.columns == ["REGIONID", "PRODUCT", "WEEK", "AVG_VOLUME", "AVG_MA", "AVG_RATIO"]
    assert df.count() > 0


def test_contract_keys():
    mod = _entry()
    q, o = mod.queries(), mod.oracle_sql()
    assert len(q) >= 60 and set(o) <= set(q)
    assert all(callable(f) for f in q.values())
