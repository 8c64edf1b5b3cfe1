"""The entry module on a copy of the tree, with and without what may be absent."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("absent", [["llm"], ["llm", "corpus_pipeline.py"]])
def test_import_without_training_data_operators(tmp_path, absent):
    skip = shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse", *absent)
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=copy, env=environment, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
    queries, statements = map(int, done.stdout.split())
    assert queries == statements >= 54
