import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomframe.operators.ordering import ROWS_PER_RANGE_CONF  # noqa: E402
from loomframe.session import get_session, release  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = str(tmp_path_factory.mktemp("work"))
    session = get_session(
        "local[8]", "tests",
        **{"spark.sql.shuffle.partitions": "3", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.checkpoint.dir": work},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture(params=["one range", "many ranges"])
def ranges(request, spark):
    """Run a test on the plain path and again with tables cut into ranges of a few rows."""
    if request.param == "many ranges":
        spark.conf.set(ROWS_PER_RANGE_CONF, "7")
    yield request.param
    spark.conf.unset(ROWS_PER_RANGE_CONF)


@pytest.fixture
def tiny_ranges(spark):
    spark.conf.set(ROWS_PER_RANGE_CONF, "7")
    yield
    spark.conf.unset(ROWS_PER_RANGE_CONF)
