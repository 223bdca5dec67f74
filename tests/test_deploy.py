"""The Python workers must import spindle even when the driver process runs
elsewhere (the package is shipped with addPyFile)."""

import os
import subprocess
import sys
import tempfile

SCRIPT = r"""
import importlib.util, sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
spec = importlib.util.spec_from_file_location("entry_mod", sys.argv[1])
mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(mod)
q = mod.queries()
print("ROWS", q["centroid_infer"](spark, "/root/testdata/sf0.001").count(),
      q["image_sizes"](spark, "/root/testdata/sf0.001").count(),
      q["object_line_counts"](spark, "/root/testdata/sf0.001").count(),
      q["stream_dedup_late"](spark, "/root/testdata/sf0.001").count())
"""


def test_udf_queries_run_from_another_directory():
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    elsewhere = tempfile.mkdtemp(prefix="spindle-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, entry], cwd=elsewhere, env=env,
                         capture_output=True, text=True, timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("ROWS")]
    assert line, out.stderr[-2000:]
    assert all(int(n) > 0 for n in line[0].split()[1:]) and len(line[0].split()) == 5
