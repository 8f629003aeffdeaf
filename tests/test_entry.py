"""What is left of the repository without the pipeline operators stands alone."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import __spark_entry__ as e
from roomtide.session import build_session
spark = build_session("entry", "local[2]", **{"spark.sql.shuffle.partitions": "2"})
assert set(e.oracle_sql()) <= set(e.queries())
assert not any(q == "pipeline" or q.startswith("op") and q[2].isdigit() for q in e.queries())
assert e.queries()["online_now"](spark, "/root/testdata/sf0.001").count() > 0
print("fine", len(e.queries()))
"""


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_imports_without_the_pipeline_operators(tmp_path, with_pipeline):
    """Also while corpus_pipeline.py is still there."""
    for name in os.listdir(ROOT):
        path = os.path.join(ROOT, name)
        if name == "corpus_pipeline.py" and not with_pipeline or name.startswith("."):
            continue
        if name.endswith(".py"):
            shutil.copy(path, tmp_path / name)
    shutil.copytree(os.path.join(ROOT, "roomtide"), tmp_path / "roomtide",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    out = subprocess.run([sys.executable, "-c", RUN], cwd=tmp_path, text=True, timeout=300,
                         capture_output=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert "fine" in out.stdout, out.stderr[-2000:]
