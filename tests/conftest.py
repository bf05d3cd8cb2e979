import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from cratecast.session import tune

    ck = str(tmp_path_factory.mktemp("ckpt"))
    s = (
        SparkSession.builder.master("local[*]")
        .appName("cratecast-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", ck)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    tune(s)
    yield s
    s.stop()
