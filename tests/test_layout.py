"""The repository without the operators for training data."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]
CHECK = """
import __spark_entry__ as entry
names = set(entry.queries())
assert names == set(entry.registry.queries()) and set(entry.oracle_sql()) == names
assert not [name for name in names if name.startswith("op") or name == "pipeline"]
import bench
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_works_without_the_subpackage(tmp_path, pipeline):
    """With and without the pipeline's own file, which lies beside the package."""
    left = shutil.ignore_patterns("llm", ".git", "__pycache__", *(() if pipeline else ("corpus_pipeline.py",)))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=left)
    run = lambda *arguments: subprocess.run(
        [sys.executable, *arguments], cwd=tmp_path / "copy", env={"PYTHONPATH": "", "PATH": ""}, capture_output=True, text=True
    )
    found = run("-c", CHECK)
    assert found.returncode == 0, found.stderr
    found = run("-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider")
    assert found.returncode == 0, found.stdout


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "quoteflow").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "quoteflow.llm" not in path.read_text(), path
