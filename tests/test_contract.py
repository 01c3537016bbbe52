"""The driver's entry points."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


def test_entry_points():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) > 100


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="driver tables are not here")
def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and "ew_close_ret" in df.columns


def test_without_the_text_operators(tmp_path):
    """The rest imports and keeps its queries when that part is deleted."""
    for p in ("panelforge", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / p).is_dir() else shutil.copy)(ROOT / p, tmp_path / p)
    shutil.rmtree(tmp_path / "panelforge/llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert not [k for k in q if k.startswith('op') and k[2].isdigit()] and 'pipeline' not in q; print(len(q))"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode == 0 and int(out.stdout) > 100, out.stderr
