import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from casetrail.session import with_checkpoint_dir
    s = (with_checkpoint_dir(SparkSession.builder).master("local[4]").appName("casetrail-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="casetrail-test-")


def D(s):
    return dt.date.fromisoformat(s)
