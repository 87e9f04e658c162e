"""Lost tasks: a write and a stream micro-batch whose first task attempt fails are retried
and keep every row exactly once. Runs in its own process, because task retries need a
fresh ``local[N, maxFailures]`` context."""

import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_failed_task_attempts_are_retried_without_loss_or_duplicates(sf_small):
    env = dict(os.environ, PYTHONPATH=os.path.dirname(HERE))
    out = subprocess.run(
        [sys.executable, os.path.join(HERE, "faults_job.py"), sf_small],
        capture_output=True, text=True, timeout=600, env=env,
    )
    lines = [ln for ln in out.stdout.splitlines() if ln.split(":")[0] in
             ("write", "stream", "compact")]
    assert out.returncode == 0 and len(lines) == 3, (out.stdout[-2000:], out.stderr[-2000:])
    assert all(ln.endswith("OK") for ln in lines), lines
