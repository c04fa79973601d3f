import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", 8,
        {
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
            # The test tables are tiny: compiling code takes longer than interpreting it.
            "spark.sql.codegen.wholeStage": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(params=["broadcast", "shuffled"])
def join_path(request, spark):
    """Run a test once with broadcast joins and once with shuffled ones."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    if request.param == "shuffled":
        spark.conf.set(key, "-1")
    yield request.param
    spark.conf.set(key, before)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
