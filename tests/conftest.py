import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def trades_frame(spark):
    """Builds a trade table from (trade_id, symbol, price, quantity, side, event_time) tuples."""
    from tapewright.schemas import TRADE

    return lambda rows: spark.createDataFrame(rows, TRADE)
