"""Structured Streaming forms of ingestion, indicators, gaps and alerts.

State is kept per series. A micro-batch of a series may reach the function in several pieces and
unordered, so the rows are gathered and sorted before the state moves on; the size of a micro-batch
is bounded by the trigger options of the source. Rows at or before the last seen time are late:
they come out marked ``late`` and change no state, to be repaired by the batch operators.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from wickframe.operators.clean import clean_candles, has_inf, has_null, is_positive, is_valid_ohlc
from wickframe.schema import OHLCV, SERIES, STEP_MS, TIME
from wickframe.sources import store

KEYS = list(SERIES)
KEY_SCHEMA = f"symbol string, timeframe string, {TIME} timestamp"


def stream_bars(events: DataFrame, timeframe: str = "1h", delay: str = "1 hour") -> DataFrame:
    """Tumbling bars from ``ts``, ``event_type``, ``event_id`` and ``value``; a bar comes out when its window has closed."""
    width = f"{STEP_MS[timeframe] // 1000} seconds"
    ev = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    order = F.struct("ts", "event_id")
    return (
        ev.groupBy(F.window("ts", width), F.col("event_type").alias("symbol"))
        .agg(
            F.min_by("value", order).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", order).alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
        .select("symbol", F.lit(timeframe).alias("timeframe"), F.col("window.start").alias(TIME), *OHLCV)
    )


def stream_clean(candles: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Valid rows, the first arrival per series and ``open_time``.

    Bad rows are removed before the duplicates: in a stream the first arrival wins, so a bad one
    must not take the place of a good one.
    """
    good = candles.filter(~has_null()).filter(~has_inf() & is_positive() & is_valid_ohlc())
    return good.withWatermark(TIME, delay).dropDuplicatesWithinWatermark([*KEYS, TIME])


def stream_latest(candles: DataFrame) -> DataFrame:
    """Newest candle per series, for update mode."""
    return candles.groupBy(*KEYS).agg(F.max(TIME).alias(TIME), *[F.max_by(c, TIME).alias(c) for c in OHLCV])


def upsert_batch(spark: SparkSession, path: str, log_path: str, scratch: str, seq: str = "seq", query: str = "batch"):
    """Function for ``foreachBatch``: clean, merge into the table, append to the run log.

    A run has its own folder under ``scratch`` (shared, and kept from run to run) by query and batch id. A repeated batch finds
    there the merged rows and counts of its first run and writes them again, and its events replace those of that run;
    so a restart after a failure, wherever it struck, leaves table, counts and log as if the batch had run once.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        at, run_id = F.current_timestamp(), f"{query}-{batch_id}"
        if seq not in batch.columns:
            raise ValueError(f"column {seq} is needed to tell which of several candles came last")
        cleaned = clean_candles(batch, seq=seq)
        started = store.log_start(cleaned.select(*KEYS).distinct(), "incremental", at, run_id)
        try:
            counts = store.merge_into_store(spark, path, cleaned, at, f"{scratch}/{run_id}", repeatable=True)
        except Exception as error:
            store.log_finish(started, None, at, str(error)).write.mode("append").parquet(f"{log_path}/run={run_id}")
            raise
        events = started.unionByName(store.log_finish(started, counts, F.current_timestamp()))
        events.write.mode("overwrite").parquet(f"{log_path}/run={run_id}")

    return run


def stream_upsert(candles: DataFrame, path: str, log_path: str, scratch: str, checkpoint: str):
    """Continuous upsert of what is available now; returns the streaming query.

    Run ids come from the checkpoint folder, so runs of different streams stay apart in the log.
    """
    writer = upsert_batch(candles.sparkSession, path, log_path, scratch, query=str(uuid.uuid5(uuid.NAMESPACE_URL, checkpoint)))
    return candles.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _stateful(candles: DataFrame, step, outputs: str, state: str) -> DataFrame:
    """Run ``step(rows, state) -> (frame, state)`` over the ordered new rows of each series."""
    names = [c.strip().split(" ")[0] for c in outputs.split(",")]

    def run(key, pieces, group):
        rows = pd.concat(list(pieces)).sort_values(TIME, kind="stable")
        old = group.get if group.exists else None
        last = old[0] if old else None
        late = pd.Series(False, index=rows.index) if last is None else rows[TIME] <= last
        late |= rows[TIME].duplicated(keep="first")
        fresh = rows[~late]
        if len(fresh):
            cols, rest = step(fresh, old[1:] if old else None, key[1])
            group.update((fresh[TIME].iloc[-1], *rest))
            out = pd.DataFrame({"symbol": key[0], "timeframe": key[1], TIME: fresh[TIME].to_numpy(), "late": False, **cols})
            yield out
        if late.any():
            gone = rows[late]
            yield pd.DataFrame(
                {"symbol": key[0], "timeframe": key[1], TIME: gone[TIME].to_numpy(), "late": True, **{n: np.full(len(gone), np.nan) for n in names}}
            )

    return (
        candles.select(*KEYS, TIME, *OHLCV)
        .groupBy(*KEYS)
        .applyInPandasWithState(
            run, f"{KEY_SCHEMA}, late boolean, {outputs}", f"last timestamp, {state}", "append", GroupStateTimeout.NoTimeout
        )
    )


def _ewm(x: np.ndarray, start: float | None, alpha: float) -> np.ndarray:
    """Weighted mean that goes on from its last value."""
    if start is None:
        return pd.Series(x).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    return pd.Series(np.concatenate([[start], x])).ewm(alpha=alpha, adjust=False).mean().to_numpy()[1:]


def stream_indicators(candles: DataFrame) -> DataFrame:
    """EMA, MACD, Wilder RSI and ATR and drawdown, continued from the last values of each series."""

    def step(rows, old, _):
        close, high, low = (rows[c].to_numpy(dtype=float) for c in ("close", "high", "low"))
        prev, e12, e26, sig, gain, loss, atr, peak = old if old else [None] * 8
        before = np.concatenate([[np.nan if prev is None else prev], close[:-1]])
        move = close - before
        up, down = np.where(move > 0, move, 0.0), np.where(move < 0, -move, 0.0)
        tr = np.fmax(high - low, np.fmax(np.abs(high - before), np.abs(low - before)))
        ema_12, ema_26 = _ewm(close, e12, 2 / 13), _ewm(close, e26, 2 / 27)
        macd = ema_12 - ema_26
        signal = _ewm(macd, sig, 0.2)
        avg_gain, avg_loss, atr_14 = _ewm(up, gain, 1 / 14), _ewm(down, loss, 1 / 14), _ewm(tr, atr, 1 / 14)
        top = np.maximum.accumulate(close if peak is None else np.concatenate([[peak], close]))[-len(close) :]
        safe = np.where(avg_loss == 0, np.nan, avg_loss)
        cols = {
            "ema_12": ema_12,
            "ema_26": ema_26,
            "macd": macd,
            "macd_signal": signal,
            "macd_hist": macd - signal,
            "rsi_14": 100 - 100 / (1 + avg_gain / safe),
            "atr_14": atr_14,
            "drawdown_pct": (close - top) / top * 100,
        }
        ends = (close, ema_12, ema_26, signal, avg_gain, avg_loss, atr_14, top)
        return cols, tuple(float(x[-1]) for x in ends)

    outputs = "ema_12 double, ema_26 double, macd double, macd_signal double, macd_hist double, rsi_14 double, atr_14 double, drawdown_pct double"
    state = "prev double, e12 double, e26 double, sig double, gain double, loss double, atr double, peak double"
    out = _stateful(candles, step, outputs, state)
    return out.withColumn("rsi_14", F.when(~F.isnan("rsi_14"), F.col("rsi_14")))


def stream_gaps(candles: DataFrame) -> DataFrame:
    """Gaps between consecutive bars: end, start in epoch milliseconds, and missing candles."""

    def step(rows, old, timeframe):
        ms = rows[TIME].to_numpy().astype("datetime64[ms]").astype("int64").astype(float)
        before = np.concatenate([[np.nan if old is None else old[0]], ms[:-1]])
        width = STEP_MS.get(timeframe)
        wide = (ms - before) > 1.5 * width if width else np.zeros(len(ms), dtype=bool)
        missing = np.where(wide, np.round((ms - before) / (width or 1)) - 1, np.nan)
        return {"gap_start_ms": np.where(wide, before, np.nan), "missing": missing}, (float(ms[-1]),)

    out = _stateful(candles, step, "gap_start_ms double, missing double", "ms double")
    return out.filter(~F.col("late") & F.col("missing").isNotNull() & ~F.isnan("missing")).select(
        *KEYS, F.timestamp_millis(F.col("gap_start_ms").cast("bigint")).alias("gap_start"), F.col(TIME).alias("gap_end"), F.col("missing").cast("bigint")
    )


def stream_anomaly(candles: DataFrame, z_threshold: float = 3.0, volume_threshold: float = 3.0, n: int = 60, m: int = 20) -> DataFrame:
    """Alerts on the price z-score over ``n`` bars and the volume ratio over ``m`` bars."""

    def step(rows, old, _):
        closes, volumes = (list(old[0]), list(old[1])) if old else ([], [])
        c = pd.Series(closes + rows["close"].tolist(), dtype=float)
        v = pd.Series(volumes + rows["volume"].tolist(), dtype=float)
        std = c.rolling(n).std().replace(0.0, np.nan)
        z = ((c - c.rolling(n).mean()) / std).to_numpy()[-len(rows) :]
        ratio = (v / v.rolling(m).mean().replace(0.0, np.nan)).to_numpy()[-len(rows) :]
        return {"price_zscore": z, "volume_ratio": ratio}, (c.tolist()[-(n - 1) :], v.tolist()[-(m - 1) :])

    out = _stateful(candles, step, "price_zscore double, volume_ratio double", "closes array<double>, volumes array<double>")
    z, r = (F.when(~F.isnan(c), F.col(c)) for c in ("price_zscore", "volume_ratio"))
    return (
        out.filter(~F.col("late"))
        .withColumns({"price_zscore": z, "volume_ratio": r})
        .withColumns({"z_alert": F.coalesce(F.abs("price_zscore") > z_threshold, F.lit(False)), "volume_alert": F.coalesce(F.col("volume_ratio") > volume_threshold, F.lit(False))})
        .filter(F.col("z_alert") | F.col("volume_alert"))
        .drop("late")
    )


def run_to_files(df: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is available now in append mode into parquet files."""
    df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
