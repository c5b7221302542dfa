"""Python operators must not need this package on the workers."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from shelfcast.session import build_session
spark = build_session("workers", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
from __spark_entry__ import queries
for key in ("UDF2", "UDF3", "AGG11"):
    assert queries()[key](spark, "/root/testdata/sf0.001").count() > 0
print("all ran")
"""


def test_runs_from_another_folder(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root)], cwd=tmp_path, capture_output=True,
                          text=True, timeout=300)
    assert "all ran" in done.stdout, done.stderr[-2000:]
