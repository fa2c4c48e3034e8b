import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import build_session

    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "millrace-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "checkpoint"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
