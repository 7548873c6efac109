"""The library without its optional part."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_works_without_the_optional_part(tmp_path):
    """``tillwise/llm`` and ``tests/llm`` are gone, ``corpus_pipeline.py`` stays or goes."""
    skip = shutil.ignore_patterns("llm", "tests", ".git", "__pycache__", "*.json", "*.txt")
    code = (
        "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql();"
        "assert 'monthly_volume' in q and set(o) <= set(q);"
        "assert not [n for n in q if n == 'pipeline' or n.startswith('op1')]"
    )
    for drop in (False, True):
        copy = tmp_path / f"copy-{drop}"
        shutil.copytree(ROOT, copy, ignore=skip)
        if drop:
            (copy / "corpus_pipeline.py").unlink(missing_ok=True)
        subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)


def test_nothing_else_imports_the_optional_part():
    for path in [*(ROOT / "tillwise").rglob("*.py"), *(ROOT / "oracles").rglob("*.py")]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert "tillwise.llm" not in path.read_text(), path
