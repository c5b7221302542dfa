"""The operators must not need this package on the workers."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import os, sys
os.environ.pop("PYTHONPATH", None)
sys.path.insert(0, {root!r})
from shelfcast.session import build_session
spark = build_session("workers", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
                                                 "spark.checkpoint.dir": {shared!r}}})
from __spark_entry__ import queries
for key in ("op1_exact_dedup", "op3_decontamination", "op4_toxicity", "op6_near_dedup", "op9_language_model", "op11_hard_negatives",
            "op12_spelling", "op13_sentencepiece"):
    assert queries()[key](spark, "/root/testdata/sf0.001").count() >= 0
print("all ran")
"""


def test_runs_from_another_folder(tmp_path):
    root = str(Path(__file__).resolve().parents[2])
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root, shared=str(tmp_path / "shared"))], cwd=tmp_path,
                          capture_output=True, text=True, timeout=400)
    assert "all ran" in done.stdout, done.stderr[-2000:]
