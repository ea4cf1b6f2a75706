"""Checkpoint files serve their application and go with it (separate JVM)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
JOB = """
import glob, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from closebook.session import cut_lineage
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {folder!r}).getOrCreate())
df = cut_lineage(spark.range(1000))
print("files", len(glob.glob({folder!r} + "/*/rdd-*/part-*")), "rows", df.count())
spark.stop()
"""


def test_checkpoint_files_are_removed_when_the_application_ends(tmp_path):
    folder = str(tmp_path / "shared")
    r = subprocess.run([sys.executable, "-c", JOB.format(root=ROOT, folder=folder)], capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "files 2 rows 1000" in r.stdout
    assert not [f for _, _, files in os.walk(folder) for f in files if not f.endswith(".crc")]
