from __future__ import annotations

import tempfile

import pytest

from floegrid.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "floegrid-tests", master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g",
           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp"),
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
