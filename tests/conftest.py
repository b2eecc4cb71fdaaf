import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from lapsewise import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = spark_session(
        "lapsewise-tests",
        master="local[8]",
        shuffle_partitions=2,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
