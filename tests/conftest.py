import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cellrisk.session import build_session, clear_scratch

SF_DIR = os.environ.get("CELLRISK_TEST_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "cellrisk-tests",
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_ui_enabled="false",
        spark_driver_memory="6g",
        spark_ui_showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
