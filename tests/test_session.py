import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
sys.path.insert(0, {root!r})
from lexcurate.operators import scoring
from lexcurate.plans.session import session, ship

spark = session("away", "local[2]", **{{"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1"}})
ship(spark)
ship(spark)
docs = spark.createDataFrame([("1", "plaintiff defendant", None)], "id string, text string, url string")
assert [r["score"] for r in scoring.annotated(docs, scoring.TermScorer).collect()] == [1]
"""


def test_workers_find_the_package_from_elsewhere(tmp_path):
    done = subprocess.run([sys.executable, "-c", CODE.format(root=str(ROOT))], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
