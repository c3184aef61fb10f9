"""The entry without the parts that a checkout may leave out."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SAYS = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_optional_folders(tmp_path, pipeline):
    for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline else [])):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "staylens", tmp_path / "staylens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", SAYS], cwd=tmp_path, env=clean, capture_output=True, text=True, check=False)
    assert said.returncode == 0, said.stderr[-2000:]
    queries, twins, has_pipeline = said.stdout.split()
    assert int(queries) > 100 and int(twins) > 100 and has_pipeline == "False"
