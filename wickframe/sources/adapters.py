"""Build candle tables from event or order records (the test tables hold no candles)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickframe.schema import OHLCV, SERIES, TIME


def bars(records: DataFrame, symbol: Column, timeframe: str, bucket: Column, value: Column, tie: list, volume: Column):
    """Aggregate records to candles: first/last value by ``tie`` order, extremes, and ``volume``."""
    order = F.struct(*tie)
    return records.groupBy(
        symbol.cast("string").alias("symbol"), F.lit(timeframe).alias("timeframe"), bucket.cast("timestamp").alias(TIME)
    ).agg(
        F.min_by(value, order).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, order).alias("close"),
        volume.cast("double").alias("volume"),
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_bars(spark: SparkSession, sf_dir: str, unit: str, timeframe: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return bars(
        ev,
        F.col("event_type"),
        timeframe,
        F.date_trunc(unit, F.col("ts").cast("timestamp")),
        F.col("value"),
        [F.col("ts"), F.col("event_id")],
        F.count(F.lit(1)),
    )


def bars_1h(spark, sf_dir):
    return event_bars(spark, sf_dir, "hour", "1h")


def bars_1m(spark, sf_dir):
    return event_bars(spark, sf_dir, "minute", "1m")


def bars_1d(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return bars(
        o,
        F.col("o_orderpriority"),
        "1d",
        F.date_trunc("day", F.col("o_orderdate").cast("timestamp")),
        F.col("o_totalprice"),
        [F.col("o_orderkey")],
        F.count(F.lit(1)),
    )


def bars_supp(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return bars(
        li,
        F.col("l_suppkey"),
        "1d",
        F.date_trunc("day", F.col("l_shipdate").cast("timestamp")),
        F.col("l_extendedprice"),
        [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_extendedprice")],
        F.sum("l_quantity"),
    )


def raw_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One untyped candle per event, with an arrival number ``seq`` and faults by ``seq % k``.

    Several events fall into the same hour, so every series has duplicates. Columns are strings
    with untidy names, as a text source would give them.
    """
    seq = F.col("event_id")
    v = F.col("value") + 1.0
    text = {
        " Open": v,
        "High ": v * 1.5,
        "LOW": v * 0.5,
        "Close": v * 1.25,
        "Volume": (F.pmod(seq, F.lit(97)) + 1).cast("double"),
    }
    cols = [F.col("event_type").alias("symbol"), F.lit("1h").alias("timeframe"), seq.alias("seq")]
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    cols.append(
        F.when(F.pmod(seq, F.lit(211)) == 0, F.lit("not a time"))
        .otherwise(F.date_format(hour, "yyyy-MM-dd HH:mm:ss"))
        .alias(" Open_Time ")
    )
    faults = {
        " Open": (13, "bad"),
        "Close": (17, "Infinity"),
        "Volume": (19, "-1.0"),
        "LOW": (23, "0.0"),
        "High ": (29, "0.25"),
    }
    for name, x in text.items():
        k, bad = faults[name]
        cols.append(F.when(F.pmod(seq, F.lit(k)) == 0, F.lit(bad)).otherwise(x.cast("string")).alias(name))
    return table(spark, sf_dir, "events").select(*cols)


def dirty_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed form of ``raw_candles``: unparsable fields are null."""
    from wickframe.operators.clean import coerce_types, normalize_columns

    return coerce_types(normalize_columns(raw_candles(spark, sf_dir), extra=("seq",)))


def kline_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON kline arrays as an exchange returns them: one text per (symbol, day) of hourly bars."""
    b = bars_1h(spark, sf_dir)
    ms = F.unix_millis(TIME)
    row = F.to_json(
        F.array(
            ms.cast("string"),
            *[F.col(c).cast("string") for c in OHLCV],
            (ms + 3_599_999).cast("string"),
            *[F.lit("0")] * 5,
        )
    )
    return (
        b.groupBy(*SERIES, F.date_trunc("day", TIME).alias("batch"))
        .agg(F.array_sort(F.collect_list(F.struct(ms.alias("ms"), row.alias("row")))).alias("rows"))
        .select(
            *SERIES,
            "batch",
            F.concat(F.lit("["), F.concat_ws(",", F.transform("rows", lambda r: r["row"])), F.lit("]")).alias("payload"),
        )
    )
