import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from oracle_check import session

    s = session()
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def candle_rows(n, symbol="A", timeframe="1d", start="2023-01-01", seed=1, flat=False):
    """Random walk candles as a pandas frame."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(seed)
    close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
    if flat:
        close[: n // 3] = 100.0
    open_ = np.concatenate([[100.0], close[:-1]])
    return pd.DataFrame(
        {
            "symbol": symbol,
            "timeframe": timeframe,
            "open_time": pd.date_range(start, periods=n, freq={"1d": "D", "1h": "h", "1m": "min"}[timeframe]),
            "open": open_,
            "high": np.maximum(open_, close) + 1.5,
            "low": np.minimum(open_, close) - 1.5,
            "close": close,
            "volume": 1000.0 + 10 * rng.integers(0, 50, n),
        }
    )
