import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from plotstats.session import build_session

    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def every_group_hot(spark):
    """Groups of more than three rows take the path for large groups."""
    spark.conf.set("plotstats.hot.rows", "3")
    yield
    spark.conf.unset("plotstats.hot.rows")


@pytest.fixture
def small_sorts(spark):
    """No task sorts more than 50 values of a group: intervals are narrowed several times."""
    spark.conf.set("plotstats.sort.rows", "50")
    yield
    spark.conf.unset("plotstats.sort.rows")
