import json
import os
import subprocess
import sys
import tempfile

from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    out = subprocess.run([sys.executable, "-m", "tastemap", *args], cwd=REPO, capture_output=True, text=True,
                         timeout=600, check=True)
    return [json.loads(line) for line in out.stdout.splitlines() if line.startswith("{")]


def test_split_then_popularity():
    work = tempfile.mkdtemp(prefix="tastemap-cli-")
    splits = os.path.join(work, "splits")
    assert _run("split", "--sf-dir", SF_SMALL, "--out", splits) == [{"splits": splits}]
    rows = _run("popularity", "--splits", splits, "--k", "100")
    assert [r["split"] for r in rows] == ["val", "test"]
    assert all(0 <= r["ndcg_at_k"] <= 1 for r in rows)
