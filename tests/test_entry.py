"""Driver contract: entry runs, queries and oracle keys line up."""

import importlib.util
import os

from conftest import ROOT


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_contract(spark):
    m = _entry()
    qs, sql = m.queries(), m.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60
    df = m.entry(spark)
    assert df.count() > 0
    assert "permno" in df.columns and "date" in df.columns


def test_works_without_the_training_data_folders():
    """Blocking both modules is what deleting their folders does to an import."""
    import subprocess
    import sys

    code = ("import sys; sys.modules['corpus_pipeline'] = None; sys.modules['tidemark.llm'] = None; "
            "import __spark_entry__ as e; q = e.queries(); "
            "assert len(q) >= 60 and 'pipeline' not in q and not [n for n in q if n.startswith('op')]; assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)
