"""Python steps run whatever folder the driver was started from."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {scratch!r}).getOrCreate()
from signpost.sources.domain_list import read_domain_list
print("GOT", sorted(r.domain for r in read_domain_list(spark, {list!r}).collect()))
"""


def test_workers_find_the_package_from_another_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    listed = tmp_path / "list.csv"
    listed.write_text("1,Example.com\n2,b\u00fccher.example\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    script = SCRIPT.format(root=root, scratch=str(tmp_path / "scratch"), list=str(listed))
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "GOT ['example.com', 'xn--bcher-kva.example']" in done.stdout, done.stdout + done.stderr[-3000:]
