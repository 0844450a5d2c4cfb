"""The package reaches executors whose Python does not start in the repository."""

import pathlib
import subprocess
import sys

CODE = """
import sys
sys.path.insert(0, {root!r})
from corpusloom.session import local_session
import __spark_entry__ as e
spark = local_session(2, 2, "2g")
print("rows", e.queries()["doc_signals"](spark, "/root/testdata/sf0.001").count())
"""


def test_queries_run_from_any_folder(tmp_path):
    root = str(pathlib.Path(__file__).resolve().parent.parent)
    out = subprocess.run([sys.executable, "-c", CODE.format(root=root)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 200" in out.stdout, out.stderr[-2000:]
