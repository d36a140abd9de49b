"""Executors have the Python libraries, but not this package."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]

SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from lagline.session import local_session
from lagline.llm.queries import QUERIES
spark = local_session("2", 2)
seen = spark.range(2).rdd.map(lambda _: __import__("importlib").util.find_spec("lagline") is None)
assert all(seen.collect()), "the workers can import the package"
for name in ("op8_personal_data", "op9_toxicity", "op13_simplex_clusters"):
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True,
        timeout=600,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert "op8_personal_data 200" in done.stdout and "op9_toxicity 200" in done.stdout
