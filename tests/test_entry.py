"""The entry points work without the corpus operators, too."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_without_corpus_operators(tmp_path):
    shutil.copytree(f"{ROOT}/lintel", tmp_path / "lintel", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'building_summary' in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)


def test_nothing_else_imports_them():
    for folder, _, names in os.walk(f"{ROOT}/lintel"):
        if not folder.endswith("llm"):
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as f:
                        assert "llm" not in f.read(), name
