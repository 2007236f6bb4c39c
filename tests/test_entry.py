"""The driver's entry with and without the text operators."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(before: str) -> list[str]:
    code = f"import sys; {before}; import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    names, oracles = run.stdout.strip().splitlines()[-2:]
    assert set(oracles.split()) <= set(names.split())
    return names.split()


def test_without_the_text_operators():
    names = _names("sys.modules['areaflow.llm'] = None")
    assert "d35_fact_transport" in names and not [n for n in names if n.startswith("op")]


def test_an_error_inside_them_is_not_hidden():
    code = "import sys; sys.modules['numpy'] = None; import __spark_entry__"
    if os.path.isdir(os.path.join(ROOT, "areaflow", "llm")):
        assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True).returncode != 0
