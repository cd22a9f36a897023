import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sparkclassify.session import get_spark
    s = get_spark("sparkclassify-tests", master="local[*]", shuffle_partitions=8,
                  extra_conf={"spark.ui.enabled": "false",
                              "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
                              "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
