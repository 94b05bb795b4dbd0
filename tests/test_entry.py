"""The contract module on a copy of the repository without the training-data operators."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from lakesieve.queries import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parent.parent
SAYS = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_the_rest_lives_without_the_subpackage(tmp_path, pipeline_stays):
    leave = shutil.ignore_patterns("llm", "__pycache__", ".git", "*.json", *([] if pipeline_stays else ["corpus_pipeline.py"]))
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=leave)
    said = subprocess.run([sys.executable, "-c", SAYS], cwd=copy, capture_output=True, text=True, check=True)
    queries, sql = json.loads(said.stdout)
    assert queries == sorted(QUERIES) and sql == sorted(ORACLES)
