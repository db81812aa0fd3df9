import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyroll.session import build_session, clear_scratch


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    settings = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.checkpoint.dir": f"file://{shared}"}
    session = build_session("tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()
