"""The driver's entry file, and sessions started from elsewhere."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent

ELSEWHERE = """
import sys
sys.path.insert(0, {root!r})
from georisk.workspace import build_session
spark = build_session("elsewhere", **{{"spark.master": "local[2]", "spark.ui.enabled": "false"}})
from georisk.sources.occurrences import layouts
print("found", len(layouts(spark, {pattern!r})))
spark.stop()
"""


def test_only_absent_parts_are_left_out(tmp_path, monkeypatch):
    monkeypatch.syspath_prepend(str(tmp_path))
    (tmp_path / "broken_part.py").write_text("import no_such_module_anywhere\n")
    (tmp_path / "needs_llm.py").write_text("raise ModuleNotFoundError('gone', name='georisk.llm')\n")
    with pytest.raises(ModuleNotFoundError, match="no_such_module_anywhere"):
        entry.optional("broken_part", "QUERIES")
    with pytest.raises(AttributeError):
        entry.optional("driver_queries.queries", "NO_SUCH_TABLE")
    assert entry.optional("needs_llm", "QUERIES") == {}


def test_workers_find_the_package_when_the_driver_starts_elsewhere(tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(f"x,{name}\n1,2\n")
    script = ELSEWHERE.format(root=str(ROOT), pattern=f"{tmp_path}/*.csv")
    plain = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=plain, capture_output=True, text=True, timeout=300)
    assert "found 2" in done.stdout, done.stderr[-2000:]
