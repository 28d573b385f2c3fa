"""The entry without the optional text subpackage: it imports, and every other query is there."""

import os
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

LIST = "import __spark_entry__ as e; print(sorted(e.queries())); print(sorted(e.oracle_sql()))"


def keys(folder):
    out = subprocess.run([sys.executable, "-c", LIST], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder)}, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    return [set(eval(line)) for line in out.stdout.splitlines()]


@pytest.mark.parametrize("pipeline_file", [True, False])
def test_entry_without_the_text_subpackage(tmp_path, pipeline_file):
    from delivery_lake.plans.catalog import ORACLE, QUERIES

    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", "tests", *([] if pipeline_file else ["corpus_pipeline.py"]))
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=left_out)
    queries, oracle = keys(copy)
    assert queries == set(QUERIES) and oracle == set(ORACLE)
    assert not any(q.startswith("op") or q == "pipeline" for q in queries) and len(queries) >= 79
