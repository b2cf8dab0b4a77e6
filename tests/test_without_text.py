"""The rest works without the text operators, with or without their pipeline's file."""

import os
import shutil
import subprocess
import sys

import pytest

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) == set(q), any(n.startswith('op') or n == 'pipeline' for n in q))"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_imports_without_the_text_folders(tmp_path, with_pipeline):
    shutil.copytree(f"{TOP}/eventmere", tmp_path / "eventmere", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "oracles.py", *(["corpus_pipeline.py"] if with_pipeline else [])):
        if os.path.exists(f"{TOP}/{name}"):
            shutil.copy(f"{TOP}/{name}", tmp_path)
    out = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, capture_output=True, text=True, timeout=120, env=os.environ | {"PYTHONPATH": ""})
    from eventmere.plans import catalog

    assert out.stdout.split() == [str(len(catalog.queries())), "True", "False"], out.stderr[-2000:]
