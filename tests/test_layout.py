"""The rest of the library does not need the training-data operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_nothing_else_imports_llm():
    for p in (ROOT / "runloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert "llm" not in p.read_text(), p


def test_entry_without_llm(tmp_path):
    import shutil

    shutil.copytree(ROOT / "runloom", tmp_path / "runloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op1_') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
