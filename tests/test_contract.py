"""The entry module without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_module_imports_without_the_optional_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(os.path.join(ROOT, "geoweave"), copy / "geoweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), copy)
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
            "assert q and set(q) == set(o) == set(e.own_queries()); print(len(q))")
    env = {**os.environ, "PYTHONPATH": str(copy)}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[-1]) > 60


def test_nothing_in_the_library_imports_the_optional_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "geoweave")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    assert "geoweave.llm" not in open(os.path.join(folder, f), encoding="utf-8").read()
