"""Column names, types and fixed lookup values of the candle data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES = ("symbol", "timeframe")
TIME = "open_time"
PRICES = ("open", "high", "low", "close")
OHLCV = (*PRICES, "volume")
REQUIRED = (TIME, *OHLCV)

CANDLE = T.StructType(
    [T.StructField(c, T.StringType()) for c in SERIES]
    + [T.StructField(TIME, T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in OHLCV]
)

STORED_CANDLE = T.StructType(
    [T.StructField(c, T.StringType()) for c in SERIES]
    + [T.StructField(TIME, T.TimestampType())]
    + [T.StructField(c, T.DecimalType(24, 8)) for c in PRICES]
    + [T.StructField("volume", T.DecimalType(32, 8))]
    + [T.StructField(c, T.TimestampType()) for c in ("created_at", "updated_at")]
)

# Candle length in milliseconds and periods per year of each timeframe.
STEP_MS = {
    "1m": 60_000,
    "3m": 180_000,
    "5m": 300_000,
    "15m": 900_000,
    "30m": 1_800_000,
    "1h": 3_600_000,
    "2h": 7_200_000,
    "4h": 14_400_000,
    "6h": 21_600_000,
    "8h": 28_800_000,
    "12h": 43_200_000,
    "1d": 86_400_000,
    "3d": 259_200_000,
    "1w": 604_800_000,
    "1M": 2_592_000_000,
}
PERIODS_PER_YEAR = {
    "1m": 525_600,
    "3m": 175_200,
    "5m": 105_120,
    "15m": 35_040,
    "30m": 17_520,
    "1h": 8_760,
    "2h": 4_380,
    "4h": 2_190,
    "6h": 1_460,
    "8h": 1_095,
    "12h": 730,
    "1d": 252,
    "3d": 84,
    "1w": 52,
    "1M": 12,
}
DEFAULT_PERIODS = 252
CHART_BARS = {"1d": 180, "1h": 120, "4h": 150, "15m": 96}
DEFAULT_CHART_BARS = 120


def lookup(mapping: dict, key: str, default=None) -> Column:
    """Value of a small constant map for a key column; null (or ``default``) when unknown."""
    pairs = ", ".join(f"'{k}', {v}L" for k, v in mapping.items())
    value = F.expr(f"map({pairs})[{key}]")
    return value if default is None else F.coalesce(value, F.lit(default))


def step_ms(key: str = "timeframe") -> Column:
    return lookup(STEP_MS, key)


def check_timeframe(timeframe: str) -> int:
    if timeframe not in STEP_MS:
        raise ValueError(f"Unknown timeframe: {timeframe}")
    return STEP_MS[timeframe]


def require(df: DataFrame, columns) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required OHLCV columns: {missing}")
    return df
