"""Task failures and retries do not change counts or output (own Spark app)."""

import json
import os
import subprocess
import sys
import tempfile


def test_counts_and_output_exact_under_task_retries():
    base = tempfile.mkdtemp(prefix="sluice-retry-")
    out, markers = os.path.join(base, "out"), os.path.join(base, "markers")
    os.makedirs(markers)
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_job.py")
    env = dict(os.environ, SLUICE_RETRY_MARKERS=markers)
    proc = subprocess.run([sys.executable, script, out], capture_output=True, text=True, timeout=600, env=env)
    line = [ln for ln in proc.stdout.splitlines() if ln.startswith("{")]
    assert line, proc.stderr[-3000:]
    r = json.loads(line[-1])
    assert r["src"] == r["expected_src"]
    assert r["tgt"] == r["expected_tgt"] == r["written"]
    failed = sorted(os.listdir(markers))
    # both injected failures happened (map stage and writing stage) and were retried
    assert any(f.startswith("failed-1-") for f in failed) and any(f.startswith("failed-2-") for f in failed), failed
