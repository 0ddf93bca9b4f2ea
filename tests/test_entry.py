"""The entry point, also without the corpus subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]


def test_entry(spark):
    found = __spark_entry__.entry(spark)
    assert found.columns == ["k", "day", "alerts_started", "length_us", "alert_us"] and found.count() > 0


def test_sql_belongs_to_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_corpus_part(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "spanloom", tmp_path / "spanloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') and n[2].isdigit() for n in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin", "PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_the_corpus_part():
    for path in (ROOT / "spanloom").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "spanloom").parts:
            assert "spanloom.llm" not in path.read_text()
