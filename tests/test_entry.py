"""The entry works in a tree without the text operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROBE = """
import __spark_entry__ as entry
names, sql = set(entry.queries()), set(entry.oracle_sql())
assert entry.HERE == {tree!r}, entry.HERE
assert sql <= names and "daily_farm_summary" in names
assert not [n for n in names if n.startswith("op") or n == "pipeline"], names
"""


def test_entry_without_text_operators(tmp_path):
    tree = tmp_path / "tree"
    skipped = shutil.ignore_patterns("llm", ".git", "__pycache__", "tests", "spark-warehouse", "*.json")
    shutil.copytree(ROOT, tree, ignore=skipped)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", PROBE.format(tree=str(tree))], cwd=tree, env=env, capture_output=True, text=True, timeout=120,
    )
    assert done.returncode == 0, done.stderr
