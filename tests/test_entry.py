import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_imports_without_the_optional_parts(tmp_path):
    """The entry point works where the optional subpackage and the pipeline are taken out."""
    import shutil

    shutil.copytree(ROOT / "quarrylit", tmp_path / "quarrylit", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'report_frame' in q and 'pipeline' not in q and not any(k.startswith('op1') for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_every_oracle_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_flagship(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
