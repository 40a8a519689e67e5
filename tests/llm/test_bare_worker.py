"""Workers that cannot import the package: what tasks need travels with them, broadcasts included."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
CODE = """
import sys, tempfile
sys.path.insert(0, {repo!r})
from floegrid.session import get_session
from floegrid.llm.queries import REGISTRY
spark = get_session("bare", master="local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
                    "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp"),
                    "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp")}})
for name in sorted(REGISTRY):
    print(name, REGISTRY[name][0](spark, "/root/testdata/sf0.001").count())
"""


def test_every_query_runs_on_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(repo=str(REPO))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    from floegrid.llm.queries import REGISTRY
    assert [line.split()[0] for line in done.stdout.splitlines()] == sorted(REGISTRY)
