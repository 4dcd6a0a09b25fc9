"""Python workers must not need the package on their path: run the two
Python-worker paths (NFC pandas UDF, recursive splitter) from another
directory in a fresh process whose only link to the repo is sys.path."""
import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.driver.host", "127.0.0.1").config("spark.driver.bindAddress", "127.0.0.1").getOrCreate())
from docweave import api
df = spark.createDataFrame([(1, "cafe\\u0301 " + "word " * 900)], "id long, content string")
rows = api.preprocess_job(df).collect()
assert rows and rows[0].text.startswith("caf\\u00e9"), rows[:1]
print("OK", len(rows))
"""


def test_workers_need_no_installed_package():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["SPARK_LOCAL_IP"] = "127.0.0.1"
    cwd = tempfile.mkdtemp(prefix="docweave-cwd-")
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                          text=True, timeout=600)
    assert done.returncode == 0 and "OK" in done.stdout, done.stderr[-2000:]


def test_imports_need_no_session():
    script = f"import sys; sys.path.insert(0, {REPO!r}); import docweave.api, __spark_entry__; assert __spark_entry__.queries()"
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
