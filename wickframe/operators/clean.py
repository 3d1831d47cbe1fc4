"""Cleaning of raw candles: typing, staged filters and the report of what each stage removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickframe.operators.blocks import DEFAULT, Layout, Running, drop_index, index_series
from wickframe.schema import OHLCV, PRICES, REQUIRED, SERIES, TIME, require, step_ms

NULLS, DUPLICATE, INF, NON_POSITIVE, INVALID, OK = (
    "null",
    "duplicate",
    "inf",
    "non_positive",
    "invalid_ohlc",
    "ok",
)


def normalize_columns(df: DataFrame, extra=()) -> DataFrame:
    """Trim and lower-case column names, check the six required ones, keep them and the keys."""
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    require(df, REQUIRED)
    keys = [c for c in (*SERIES, *extra) if c in df.columns]
    return df.select(*keys, *REQUIRED)


def coerce_types(df: DataFrame) -> DataFrame:
    """UTC timestamps and doubles; unparsable fields and NaN become null."""
    types = dict(df.dtypes)
    cols: dict[str, Column] = {}
    if not types[TIME].startswith("timestamp"):
        cols[TIME] = F.expr(f"try_cast({TIME} as timestamp)")
    else:
        cols[TIME] = F.col(TIME).cast("timestamp")
    for c in OHLCV:
        x = F.expr(f"try_cast({c} as double)")
        cols[c] = F.when(~F.isnan(x), x)
    return df.withColumns(cols)


def has_null() -> Column:
    cond = F.col(REQUIRED[0]).isNull()
    for c in REQUIRED[1:]:
        cond = cond | F.col(c).isNull()
    return cond


def has_inf() -> Column:
    cond = F.lit(False)
    for c in OHLCV:
        cond = cond | (F.abs(c) == float("inf"))
    return cond


def is_positive() -> Column:
    cond = F.col("volume") >= 0
    for c in PRICES:
        cond = cond & (F.col(c) > 0)
    return cond


def is_valid_ohlc() -> Column:
    top = F.greatest("open", "close", "low")
    bottom = F.least("open", "close", "high")
    return (F.col("high") >= top) & (F.col("low") <= bottom)


def drop_nulls(df: DataFrame) -> DataFrame:
    return df.filter(~has_null())


def drop_inf(df: DataFrame) -> DataFrame:
    return df.filter(~has_inf())


def drop_non_positive(df: DataFrame) -> DataFrame:
    return df.filter(is_positive())


def valid_ohlc(df: DataFrame) -> DataFrame:
    return df.filter(is_valid_ohlc())


def dedupe_candles(df: DataFrame, keep: str = "last", seq: str = "seq") -> DataFrame:
    """One row per series and ``open_time``: the first or last by ``seq``.

    An aggregate, not a ranking: copies are combined before the shuffle, so a key that is
    repeated very often costs no more than any other.
    """
    pick = {"last": F.max_by, "first": F.min_by}[keep]
    rest = [c for c in df.columns if c not in (*SERIES, TIME)]
    return (
        df.groupBy(*SERIES, TIME)
        .agg(*[pick(c, seq).alias(c) for c in rest if c != seq], (F.max if keep == "last" else F.min)(seq).alias(seq))
        .select(*df.columns)
    )


def _stage_label(drop_invalid: bool) -> Column:
    if not drop_invalid:
        return F.lit(OK)
    return (
        F.when(has_inf(), INF)
        .when(~is_positive(), NON_POSITIVE)
        .when(~is_valid_ohlc(), INVALID)
        .otherwise(OK)
    )


def _deduped(df: DataFrame, keep: str, seq: str) -> DataFrame:
    pick = {"last": F.max_by, "first": F.min_by}[keep]
    return (
        drop_nulls(df)
        .groupBy(*SERIES, TIME)
        .agg(*[pick(c, seq).alias(c) for c in OHLCV], F.count(F.lit(1)).alias("_copies"))
    )


def clean_candles(df: DataFrame, keep: str = "last", seq: str = "seq", drop_invalid: bool = True) -> DataFrame:
    """Null rows out, one row per ``open_time``, then infinite, non-positive and inconsistent rows out.

    The order matters: a late bad duplicate replaces a good row and is then removed itself.
    """
    out = _deduped(df, keep, seq)
    return out.filter(_stage_label(drop_invalid) == OK).select(*SERIES, *REQUIRED)


def cleaning_report(
    df: DataFrame, keep: str = "last", seq: str = "seq", drop_invalid: bool = True, layout: Layout = DEFAULT
) -> DataFrame:
    """Per series: rows in and out, rows removed by each stage, number of gaps and a note."""
    nulls = df.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(has_null()).alias("dropped_nulls")
    )
    label = F.col("_label")
    stages = (
        _deduped(df, keep, seq)
        .withColumn("_label", _stage_label(drop_invalid))
        .groupBy(*SERIES)
        .agg(
            F.sum(F.col("_copies") - 1).alias("dropped_duplicates"),
            F.count_if(label == INF).alias("dropped_inf"),
            F.count_if(label == NON_POSITIVE).alias("dropped_non_positive"),
            F.count_if(label == INVALID).alias("dropped_invalid_ohlc"),
            F.count_if(label == OK).alias("rows_out"),
        )
    )
    gaps = gap_count(clean_candles(df, keep, seq, drop_invalid), layout)
    counts = [
        "rows_in",
        "rows_out",
        "dropped_nulls",
        "dropped_duplicates",
        "dropped_invalid_ohlc",
        "dropped_non_positive",
        "dropped_inf",
        "gap_count",
    ]
    out = nulls.join(stages, list(SERIES), "left").join(gaps, list(SERIES), "left").fillna(0, counts)
    return out.select(
        *SERIES,
        *counts,
        (F.col("rows_in") - F.col("rows_out")).alias("rows_removed"),
        F.when(
            F.col("gap_count") > 0,
            F.concat(F.lit("Detected "), F.col("gap_count").cast("string"), F.lit(" missing candle interval(s)")),
        )
        .otherwise("")
        .alias("notes"),
    )


def detect_gaps(df: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """One row per gap: distance to the candle before above 1.5 steps. Unknown timeframes have none."""
    step = step_ms()
    ms = F.unix_millis(TIME)
    return (
        drop_index(
            index_series(df.select(*SERIES, TIME), {"gap_start": Running("prev", F.col(TIME))}, layout=layout)
        )
        .filter(ms - F.unix_millis("gap_start") > step * 1.5)
        .select(
            *SERIES,
            "gap_start",
            F.col(TIME).alias("gap_end"),
            (F.round((ms - F.unix_millis("gap_start")) / step).cast("bigint") - 1).alias("missing"),
        )
    )


def gap_count(df: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Number of gap intervals and of missing candles per series (0 where there is none)."""
    gaps = detect_gaps(df, layout).groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("gap_count"), F.sum("missing").alias("missing_candles")
    )
    return df.select(*SERIES).distinct().join(gaps, list(SERIES), "left").fillna(0, ["gap_count", "missing_candles"])
