"""The entry points with and without the optional folder."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry
from lakestar.plans import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_core_queries_are_there():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_loads_without_the_optional_folder(tmp_path):
    """A copy without `lakestar/llm`, with and without the pipeline that needs it."""
    skipped = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(f"{ROOT}/lakestar", tmp_path / "lakestar", ignore=skipped)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    wanted = f"{len(QUERIES)} {len(QUERIES)}"

    def loaded() -> str:
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
        return done.stdout.strip() or done.stderr

    assert loaded() == wanted
    (tmp_path / "corpus_pipeline.py").write_text("from lakestar.llm import bpe\n")
    assert loaded() == wanted
