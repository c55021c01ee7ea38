"""The entry points can be imported before any session is started."""

import os
import subprocess
import sys


def test_import_without_a_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
