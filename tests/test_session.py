import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from loomspan.session import discard, materialize, scratch
spark = SparkSession.builder.master("local[1]").config("spark.checkpoint.dir", {where!r}).config("spark.ui.enabled", "false").getOrCreate()
with scratch(spark):
    inner = materialize(spark.range(3), "inner")
    kept = materialize(inner, "kept", keep=True)
plain = materialize(spark.range(2), "plain", compression="zstd")
gone = materialize(spark.range(1), "gone")
discard(gone)
assert kept.count() == 3 and plain.count() == 2
import os
print(sorted(n.split("-")[0] for n in os.listdir({where!r}) if n.split("-")[0] in ("inner", "kept", "plain", "gone")))
{end}
"""


def test_stored_tables_go_with_the_process(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for end in ("", "spark.stop()"):
        where = str(tmp_path / f"shared{len(end)}")
        done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root, where=where, end=end)], capture_output=True, text=True, timeout=300)
        assert "['kept', 'plain']" in done.stdout, done.stderr[-2000:]
        assert not [n for n in os.listdir(where) if n.startswith(("inner", "kept", "plain", "gone"))]
