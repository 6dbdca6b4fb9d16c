"""The entry point with and without its optional parts."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

from workload.queries import QUERIES

HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PARTS = {"llm": ("tidemark/llm", "tests/llm"), "pipeline": ("corpus_pipeline.py",)}


@pytest.mark.parametrize("gone", [["llm"], ["pipeline"], ["llm", "pipeline"]])
def test_entry_without_optional_parts(tmp_path, gone):
    home = tmp_path / "repo"
    missing = [os.path.join(HOME, path) for part in gone for path in PARTS[part]]
    shutil.copytree(HOME, home, ignore=lambda folder, names: [
        n for n in names if n == ".git" or os.path.join(folder, n) in missing])
    code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=home, capture_output=True, text=True,
                           env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
                           | {"PYTHONPATH": os.environ.get("PYTHONPATH", "").replace(HOME, "")})
    assert found.returncode == 0, found.stderr
    names = set(found.stdout.splitlines()[-1].split())
    assert set(QUERIES) <= names
    assert ("pipeline" in names) == (len(gone) == 0)
    assert any(n.startswith("op1_") for n in names) == (
        "llm" not in gone and os.path.isdir(os.path.join(HOME, "tidemark/llm")))
