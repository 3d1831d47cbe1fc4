"""Typed candles from raw exchange payloads, and the list of pages to fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickframe.operators.clean import dedupe_candles
from wickframe.schema import OHLCV, SERIES, TIME, check_timeframe


def parse_klines(df: DataFrame, payload: str = "payload", order: str = "batch", keep: str = "first") -> DataFrame:
    """JSON arrays of 12-field klines to candles; the first of several rows per ``open_time`` is kept."""
    rows = df.select(
        *SERIES, order, F.posexplode(F.from_json(payload, "array<array<string>>")).alias("_pos", "_k")
    )
    fields = [F.expr(f"try_cast(_k[{i + 1}] as double)").alias(c) for i, c in enumerate(OHLCV)]
    typed = rows.select(
        *SERIES,
        F.timestamp_millis(F.expr("try_cast(_k[0] as bigint)")).alias(TIME),
        *fields,
        F.struct(order, "_pos").alias("_seq"),
    )
    return dedupe_candles(typed, keep, "_seq").drop("_seq")


def read_kline_files(spark: SparkSession, path: str, symbol: str, timeframe: str) -> DataFrame:
    """One JSON payload per line; files and lines give the arrival order."""
    check_timeframe(timeframe)
    raw = spark.read.text(path).select(
        F.lit(symbol).alias("symbol"),
        F.lit(timeframe).alias("timeframe"),
        F.struct(F.input_file_name(), F.monotonically_increasing_id()).alias("batch"),
        F.col("value").alias("payload"),
    )
    return parse_klines(raw)


def plan_fetch_ranges(series: DataFrame, timeframe: str, limit: int = 1000) -> DataFrame:
    """Page windows of at most ``limit`` candles between ``since`` and ``until`` of every series."""
    step = check_timeframe(timeframe) * min(limit, 1000)
    start, stop = F.unix_millis("since"), F.unix_millis("until")
    pages = series.filter(start < stop).select(
        "symbol", F.lit(timeframe).alias("timeframe"), stop.alias("_stop"),
        F.posexplode(F.sequence(start, stop - 1, F.lit(step).cast("bigint"))).alias("page", "start_ms"),
    )
    return pages.select(
        "symbol", "timeframe", "page", "start_ms", (F.least(F.col("start_ms") + step, F.col("_stop")) - 1).alias("end_ms")
    )
