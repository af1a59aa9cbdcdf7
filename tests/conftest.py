import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from playgrid.session import apply_conf
    ck = tempfile.mkdtemp(prefix="playgrid-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("playgrid-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", ck)
         .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_conf(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="playgrid-test-")
