"""The driver's entry point with and without the subpackage of training-data operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(folder) -> set[str]:
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    told = subprocess.run(
        [sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True,
        env=os.environ | {"PYTHONPATH": str(folder)},
    )
    found, sql = (set(line.split()) for line in told.stdout.strip().splitlines()[-2:])
    assert sql <= found
    return found


def test_entry_works_without_the_llm_folders(tmp_path):
    shutil.copytree(ROOT / "sumstone", tmp_path / "sumstone", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    rest = names(tmp_path)
    assert not any(n.startswith("op") and n[2:3].isdigit() for n in rest) and "pipeline" not in rest
    if (ROOT / "sumstone" / "llm").exists():
        more = names(ROOT) - rest
        assert "pipeline" in more
        assert all(n == "pipeline" or n.startswith("op") and n[2:3].isdigit() for n in more)
