"""The entry module without the training-data folders, with and without their pipeline."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).parents[1]


@pytest.mark.parametrize("without", [("llm",), ("llm", "corpus_pipeline.py")])
def test_the_rest_imports(tmp_path, without):
    skip = lambda folder, names: [n for n in names if n in without or n.startswith(".git") or n == "__pycache__"]
    shutil.copytree(REPO, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; names = e.queries(); assert 'publications' in names and set(e.oracle_sql()) == set(names); print(len(names))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) >= 80
