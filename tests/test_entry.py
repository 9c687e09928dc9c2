"""The registry with and without the optional parts."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LOOK = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(len(q), sum(k == 'pipeline' or k[:2] == 'op' and k[2].isdigit() for k in q))"


@pytest.mark.parametrize("gone", [["sparkweft/llm", "tests/llm", "corpus_pipeline.py"], ["sparkweft/llm", "tests/llm"]])
def test_the_rest_works_without_the_training_data_operators(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(HERE, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json", ".pytest_cache"))
    for name in gone:
        path = copy / name
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", LOOK], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    queries, optional = map(int, done.stdout.split())
    assert queries > 50 and optional == 0
    done = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stdout
