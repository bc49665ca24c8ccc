import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
assert spark.conf.get("spark.checkpoint.dir", None) is None
import __spark_entry__ as E
from wareflow.session import checkpoint_root
n = E.queries()["upsert_publish"](spark, "/root/testdata/sf0.001").count()
root = checkpoint_root(spark)
assert root == checkpoint_root(spark)  # stable within the session
print("OK", n, root)
"""


def test_scratch_without_checkpoint_dir_setting():
    """A session with no spark.checkpoint.dir gets one registered (as in tests)."""
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="wareflow-noconf-"),
               PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "OK 1500" in out.stdout, out.stderr[-2000:]
