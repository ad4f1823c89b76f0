import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from delaykit.session import build_session

    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    session = build_session("tests", "local[8]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Collect a frame as a sorted list of plain tuples."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))

    return collect
