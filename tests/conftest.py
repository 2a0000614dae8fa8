import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tideline.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bars(spark):
    """Makes a panel from {symbol: [close, ...]}, one day after the other."""
    import datetime

    def make(closes, first=datetime.date(2020, 1, 1), days=None):
        rows = []
        for symbol, series in closes.items():
            for i, close in enumerate(series):
                day = first + datetime.timedelta(days=days[i] if days else i)
                rows.append((day, symbol, close))
        return spark.createDataFrame(rows, "Date date, symbol string, Close double")

    return make


@pytest.fixture(scope="session")
def labelled(spark):
    """Makes labels from {symbol: 'AABA'}, one day per letter."""
    import datetime

    def make(series):
        rows = [
            (datetime.date(2020, 1, 1) + datetime.timedelta(days=i), symbol, regime)
            for symbol, regimes in series.items()
            for i, regime in enumerate(regimes)
        ]
        return spark.createDataFrame(rows, "Date date, symbol string, regime string")

    return make
