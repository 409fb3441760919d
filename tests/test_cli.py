"""The batch command line, run as a user would."""
import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_list_and_run(tmp_path):
    env = dict(os.environ, PYTHONPATH=REPO)
    listed = subprocess.run([sys.executable, "-m", "chirpwave", "list"], cwd=REPO, env=env,
                            capture_output=True, text=True, timeout=120)
    assert listed.returncode == 0 and "trending_topics" in listed.stdout and "stream_state_snapshot" in listed.stdout
    out = str(tmp_path)
    run = subprocess.run([sys.executable, "-m", "chirpwave", "run", "state_snapshot", "/root/testdata/sf0.001",
                          "--out", f"{out}/snap", "--format", "json"], cwd=REPO, env=env,
                         capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]
    rows = [json.loads(line) for name in os.listdir(f"{out}/snap") if name.endswith(".json")
            for line in open(f"{out}/snap/{name}")]
    assert len(rows) == 50 and {"state", "code"} <= set(rows[0])
