"""The library without the corpus operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST_QUERIES = "import __spark_entry__ as e; print(*sorted(e.queries()), sep='\\n'); e.oracle_sql()"


@pytest.mark.parametrize("keep_pipeline", [True, False])
def test_imports_without_corpus_operators(tmp_path, keep_pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(
        os.path.join(ROOT, "stockroom"), copy / "stockroom", ignore=shutil.ignore_patterns("llm", "__pycache__")
    )
    for name in ["__spark_entry__.py", *["corpus_pipeline.py"] * keep_pipeline]:
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), copy / name)
    run = subprocess.run([sys.executable, "-c", LIST_QUERIES], cwd=copy, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    from stockroom.plans import queries  # noqa: F401
    from stockroom.plans.registry import CHECKS

    assert run.stdout.split() == sorted(CHECKS)
