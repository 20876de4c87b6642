import os
import shutil
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="figmine-tests-")
    s = (
        SparkSession.builder.master("local[4]").config("spark.checkpoint.dir", f"file://{shared}").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()
    shutil.rmtree(shared, ignore_errors=True)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
