"""The entry file in a copy of the repository without the training-data folders."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from matchmart.catalog.registry import QUERIES

ROOT = Path(contract.__file__).parent


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_without_the_training_data_folders(tmp_path, with_pipeline):
    shutil.copytree(ROOT / "matchmart", tmp_path / "matchmart", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if with_pipeline else [])):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    found = subprocess.run(
        [sys.executable, "-B", "-c", "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"],
        cwd=tmp_path, capture_output=True, text=True, timeout=120,
    )
    assert found.returncode == 0, found.stderr
    assert found.stdout.split("\n")[:2] == [" ".join(sorted(QUERIES))] * 2
