"""The library without its optional subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import __spark_entry__ as e
names = e.queries()
assert "payload_onboarding_in" in names and set(e.oracle_sql()) <= set(names)
assert not [n for n in names if n.startswith("op") and n[2:3].isdigit() or n == "pipeline"], names
print(len(names))
"""


@pytest.mark.parametrize("leave", [(), ("corpus_pipeline.py",), ("payfeed/llm/__pycache__",)])
def test_entry_points_import(tmp_path, leave):
    copy = tmp_path / "copy"
    skip = shutil.ignore_patterns(".git", "llm", "__pycache__", "corpus_pipeline.py", "spark-warehouse")
    shutil.copytree(ROOT, copy, ignore=skip)
    for name in leave:
        if name.endswith(".py"):
            shutil.copy(os.path.join(ROOT, name), copy / name) if os.path.exists(os.path.join(ROOT, name)) else None
        else:
            os.makedirs(copy / name)
    run = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr[-2000:]
    assert int(run.stdout.split()[-1]) > 80


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "payfeed")):
        for name in files:
            if name.endswith(".py") and os.sep + "llm" not in folder:
                assert "payfeed.llm" not in open(os.path.join(folder, name)).read(), name
