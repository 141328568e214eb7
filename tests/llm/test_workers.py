"""Operators that broadcast objects, with workers that cannot import the package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from keyedlake.llm import queries
from keyedlake.session import build_session

spark = build_session("local[2]", shuffle_partitions=2)


def importable(batches):
    import importlib.util
    for batch in batches:
        yield batch.assign(found=importlib.util.find_spec("keyedlake") is not None)[["found"]]


assert not spark.range(1).mapInPandas(importable, "found boolean").first()[0]
for name in ("op8_decontamination", "op9_language_id", "op10_quality"):
    print(name, queries.QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [line.split()[1] for line in done.stdout.splitlines() if line.startswith("op")] == ["200"] * 3
