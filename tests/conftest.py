import tempfile

import pytest

from daybook.session import build_session, scratch_database


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "daybook-tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="daybook-warehouse-"),
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def db(spark):
    return scratch_database(spark, "test")
