"""The entry point with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_without_corpus_operators(tmp_path):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'change_envelope' in q and set(o) <= set(q) and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["operation", "schema", "table", "lsn", "xid", "commit_timestamp", "before", "after"]


def test_without_a_package_of_the_corpus_operators(tmp_path):
    """The corpus operators are there but can't be imported: the other queries stay."""
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; q = e.queries(); assert 'change_envelope' in q and not any(n.startswith('op') or n == 'pipeline' for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
