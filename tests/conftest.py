import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from telvault.session import get_spark
    s = get_spark("local[4]", app_name="telvault-tests", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.driver.extraJavaOptions": f"-Dderby.system.home={tmp_path_factory.mktemp('derby')}",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
