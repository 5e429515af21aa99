import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tickerpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
