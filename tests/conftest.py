import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from scanloom.session import session

    tmp = tmp_path_factory.mktemp("spark")
    s = session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "3g", "spark.checkpoint.dir": f"file://{tmp}/shared",
        "spark.sql.warehouse.dir": f"{tmp}/warehouse", "spark.driver.host": "127.0.0.1",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
