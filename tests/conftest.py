from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lexcurate.plans.session import session

    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.driver.host": "127.0.0.1"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def small():
    if not Path(SMALL).exists():
        pytest.skip("no test tables here")
    return SMALL
