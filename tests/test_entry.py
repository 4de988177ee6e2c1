import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
from quarrystone.plans import catalogue, oracles

ROOT = Path(entry.__file__).parent


def test_flagship(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["doc_id", "page_number", "raw_file", "text_sha256", "text_length"] and frame.count() > 0


def test_names_agree():
    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(oracles.ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_works_without_the_training_data_part(tmp_path):
    shutil.copytree(ROOT / "quarrystone", tmp_path / "quarrystone", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert said.stdout.split() == [str(len(catalogue.QUERIES)), "False"], said.stderr


def test_nothing_else_imports_the_training_data_part():
    for path in (ROOT / "quarrystone").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(), path
