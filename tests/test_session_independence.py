"""All queries give the oracle's answer from a plain session: other time zone, default
shuffle partitions, no checkpoint folder preset (separate JVM)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_plain_session_other_time_zone():
    env = dict(os.environ, TZ="America/Los_Angeles")
    r = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "vanilla_check.py")],
                       env=env, capture_output=True, text=True, timeout=1500)
    assert r.returncode == 0, r.stdout[-2000:] + r.stderr[-2000:]
    assert "mismatches: []" in r.stdout
