"""What the driver calls."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).parents[1]


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_optional_parts(tmp_path):
    for name in ("tidewell", "__spark_entry__.py", "corpus_pipeline.py"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "tidewell/llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'q6_revenue' in q and 'pipeline' not in q and not any(n.startswith('op1_') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"} | {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})
