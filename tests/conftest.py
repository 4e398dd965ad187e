import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lectern.session import build_session, shared_folder, ship_package

    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    session.sparkContext.setLogLevel("ERROR")
    shared_folder(session)
    ship_package(session)
    session.sparkContext.addPyFile(str(ROOT / "tests" / "fakes.py"))
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)
