"""A session without any preset configuration, in a process of its own."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
from conform.session import local_session, scratch_path, scratch_root
from conform.sources.tables import precompute
spark = local_session(2, 2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert sorted(r.id for r in precompute(spark.range(3)).collect()) == [0, 1, 2]
assert scratch_root(spark) == scratch_root(spark) and scratch_path(spark, "x").startswith(scratch_root(spark))
print("staged and read")
"""


def test_a_bare_local_session_stages_and_reads(tmp_path):
    empty = tmp_path / "conf"
    empty.mkdir()
    env = {**os.environ, "SPARK_CONF_DIR": str(empty), "PYTHONPATH": ROOT, "TMPDIR": str(tmp_path)}
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    done = subprocess.run([sys.executable, "-c", CODE], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert "staged and read" in done.stdout, done.stderr[-2000:]
