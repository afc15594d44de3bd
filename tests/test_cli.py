"""The command line, in its own process (it owns its Spark session)."""

import os
import subprocess
import sys

from golden import LINES, write

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def cli(*args):
    r = subprocess.run([sys.executable, "-m", "bitlake", *args], cwd=REPO, capture_output=True, text=True,
                       timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    return [ln for ln in r.stdout.splitlines() if ln and not ln.startswith(("WARN", "Using", "Setting"))]


def test_load_and_query(tmp_path):
    root = write(str(tmp_path / "pixel"), LINES)
    store = str(tmp_path / "store")
    cli("--store", store, "load", "--root", root, "--max-files", "2", "--until-done",
        "--shard-width", "2", "--lanes", "2")
    assert sorted(cli("--store", store, "query", "row", "--leaf", "ofield=o1")) == ["u1", "u2", "u3"]
    assert cli("--store", store, "query", "topn", "--field", "cfield", "-n", "1") == ["c2\t3"]
    assert cli("--store", store, "query", "count", "--leaf", "ofield=o1@2018-07-01..2018-07-02") == ["2"]
