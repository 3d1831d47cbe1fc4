"""Indicators, gaps and alerts of a stream whose micro-batches may hold very long stretches of one series.

Every micro-batch is computed by the block operators of the batch side: the state of each series enters as one or a few rows before its
new rows, marked ``_state``, and these rows begin the running aggregates and weighted means. So the rows of a series are spread over
tasks by time bucket and block, no task gathers a series, and results equal those of the batch operators over all rows at once.

The state (one row per series, or the newest ``n - 1`` bars for rolling windows) is a small table per batch id under ``state``; a batch reads the
newest one before it and writes its results and its state under its own id. A repeated batch therefore writes the same again. Folders
of batches before the last two are not read any more.

Rows at or before the last seen time of their series, further rows of one series and time (the smallest candle by its values counts) and
rows with a null symbol, timeframe or time come out marked ``late`` and change no state. Prices are expected to be clean
(``stream_clean`` goes before): a null price at the end of a batch does not fade the means. Empty batches write no rows and keep the state.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickframe.operators.blocks import DEFAULT, Layout, Running, block_rows, index_series, own, row_blocks
from wickframe.operators.scans import Ewm, Roll, arranged, block_carry, with_scans
from wickframe.plans.lineage import written
from wickframe.schema import OHLCV, SERIES, TIME, step_ms

KEYS = list(SERIES)
BAR = ", ".join([f"{TIME} timestamp", *[f"{c} double" for c in OHLCV]])
MEANS = ("ema_12", "ema_26", "macd_signal", "avg_gain", "avg_loss", "atr_14")
INDICATORS = ("ema_12", "ema_26", "macd", "macd_signal", "macd_hist", "rsi_14", "atr_14", "drawdown_pct")


@dataclass(frozen=True)
class Step:
    """``compute`` adds ``outputs`` to new rows and state rows, which it indexes by series; the newest ``keep`` rows are the next state."""

    compute: Callable[[DataFrame], DataFrame]
    outputs: tuple[str, ...]
    state: tuple[str, ...] = ()
    keep: int = 1

    @property
    def schema(self) -> T.StructType:
        extra = "".join(f", {c} double" for c in self.state)
        return T._parse_datatype_string(f"symbol string, timeframe string, {BAR}{extra}")


def _means(rows: DataFrame, columns: dict[str, Ewm], layout: Layout) -> DataFrame:
    """Weighted means of an indexed frame, over as many blocks as its series need."""
    blocks = row_blocks(rows, 0, layout)
    several = blocks.filter(F.col("_total") > block_rows(0, layout))
    found = with_scans(arranged(blocks, carry=written(block_carry(arranged(several), columns))), columns)
    return own(found).drop(*[f"{p}_{c}" for c in columns for p in ("_v", "_g")])


def _or_state(name: str, value: Column) -> Column:
    return F.when(F.col("_state"), F.col(f"s_{name}")).otherwise(value)


def indicators_step(layout: Layout = DEFAULT) -> Step:
    """EMA, MACD, Wilder RSI and ATR, and drawdown."""

    def compute(rows: DataFrame) -> DataFrame:
        peak = F.when(F.col("_state"), F.col("s_peak")).otherwise(F.col("close"))
        rows = index_series(rows, {"_before": Running("prev", F.col("close")), "peak": Running("max", peak)}, layout=layout)
        before, move = F.col("_before"), F.col("close") - F.col("_before")
        span = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))
        rows = rows.withColumns(
            {
                "_x12": _or_state("ema_12", F.col("close")),
                "_x26": _or_state("ema_26", F.col("close")),
                "_up": _or_state("avg_gain", F.when(move > 0, move).otherwise(0.0)),
                "_down": _or_state("avg_loss", F.when(move < 0, -move).otherwise(0.0)),
                "_tr": _or_state("atr_14", span),
            }
        )
        wilder = 1 / 14
        first = {"ema_12": Ewm.span("_x12", 12), "ema_26": Ewm.span("_x26", 26)}
        first |= {"avg_gain": Ewm("_up", wilder), "avg_loss": Ewm("_down", wilder), "atr_14": Ewm("_tr", wilder)}
        rows = _means(written(rows), first, layout).withColumn("macd", F.col("ema_12") - F.col("ema_26"))
        rows = _means(written(rows.withColumn("_line", _or_state("macd_signal", F.col("macd")))), {"macd_signal": Ewm.span("_line", 9)}, layout)
        strength = 100 - 100 / (1 + F.col("avg_gain") / F.col("avg_loss"))
        return rows.withColumns(
            {
                "macd_hist": F.col("macd") - F.col("macd_signal"),
                "rsi_14": F.when(F.col("avg_loss") != 0, strength),
                "drawdown_pct": (F.col("close") - F.col("peak")) / F.col("peak") * 100,
            }
        )

    return Step(compute, INDICATORS, (*MEANS, "peak"))


def gaps_step(layout: Layout = DEFAULT) -> Step:
    """Start of the gap before a bar, and the number of missing candles."""

    def compute(rows: DataFrame) -> DataFrame:
        rows = index_series(rows, {"_before": Running("prev", F.col(TIME))}, layout=layout)
        ahead = F.unix_millis(TIME) - F.unix_millis("_before")
        wide = ahead > 1.5 * step_ms()
        missing = F.when(wide, F.round(ahead / step_ms()).cast("bigint") - 1)
        return rows.withColumns({"gap_start": F.when(wide, F.col("_before")), "missing": missing})

    return Step(compute, ("gap_start", "missing"))


def anomaly_step(n: int = 60, m: int = 20, layout: Layout = DEFAULT) -> Step:
    """Price z-score over ``n`` bars and volume ratio over ``m`` bars."""

    def compute(rows: DataFrame) -> DataFrame:
        blocks = arranged(row_blocks(index_series(rows, layout=layout), max(n, m), layout))
        rolls = {"_mean": Roll("mean", "close", n), "_std": Roll("std", "close", n), "_usual": Roll("mean", "volume", m)}
        rows = own(with_scans(blocks, rolls))
        return rows.withColumns(
            {
                "price_zscore": F.when(F.col("_std") != 0, (F.col("close") - F.col("_mean")) / F.col("_std")),
                "volume_ratio": F.when(F.col("_usual") != 0, F.col("volume") / F.col("_usual")),
            }
        )

    return Step(compute, ("price_zscore", "volume_ratio"), keep=max(n, m) - 1)


def sorted_out(batch: DataFrame, last: DataFrame) -> DataFrame:
    """One row per series and time with ``fresh`` and the number of late ``copies``; ``last`` holds the last seen time of each series."""
    bar = F.struct(*[F.col(c).cast("double").alias(c) for c in OHLCV])
    one = batch.groupBy(*KEYS, F.col(TIME).cast("timestamp").alias(TIME)).agg(F.min(bar).alias("_bar"), F.count(F.lit(1)).alias("_n"))
    known = F.col("symbol").isNotNull() & F.col("timeframe").isNotNull() & F.col(TIME).isNotNull()
    fresh = known & (F.col("_last").isNull() | (F.col(TIME) > F.col("_last")))
    return (
        one.join(last, KEYS, "left")
        .withColumn("fresh", fresh)
        .select(*KEYS, TIME, "_bar.*", "fresh", (F.col("_n") - F.col("fresh").cast("int")).alias("copies"))
    )


def carried(step: Step, path: str, state: str):
    """Function for ``foreachBatch``: results under ``path/batch=<id>``, state under ``state/<id>``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = spark.read.schema(step.schema).parquet(f"{state}/{batch_id - 1}") if batch_id else spark.createDataFrame([], step.schema)
        rows = written(sorted_out(batch, old.groupBy(*KEYS).agg(F.max(TIME).alias("_last"))))
        new = rows.filter("fresh").select(*KEYS, TIME, *OHLCV, F.lit(False).alias("_state"))
        begin = old.select(*KEYS, TIME, *OHLCV, F.lit(True).alias("_state"), *[F.col(c).alias(f"s_{c}") for c in step.state])
        columns = list(dict.fromkeys([*KEYS, TIME, *OHLCV, *step.state, *step.outputs, "_state", "_rn", "_total"]))
        done = written(step.compute(begin.unionByName(new, allowMissingColumns=True)).select(*columns))
        ends = done.filter(F.col("_rn") >= F.col("_total") - step.keep)
        ends.select(*KEYS, TIME, *OHLCV, *step.state).write.mode("overwrite").parquet(f"{state}/{batch_id}")
        out = done.filter("not _state").select(*KEYS, TIME, F.lit(False).alias("late"), *step.outputs)
        late = rows.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        late = late.select(*KEYS, TIME, F.lit(True).alias("late"))
        out.unionByName(late, allowMissingColumns=True).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run


def run_carried(candles: DataFrame, step: Step, path: str, state: str, checkpoint: str) -> None:
    """Process what is available now; goes on from the state of earlier runs with the same folders."""
    writer = candles.writeStream.foreachBatch(carried(step, path, state)).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def gaps(results: DataFrame) -> DataFrame:
    """Gaps out of the results of ``gaps_step``."""
    return results.filter("not late and missing is not null").select(*KEYS, "gap_start", F.col(TIME).alias("gap_end"), "missing")


def alerts(results: DataFrame, z_threshold: float = 3.0, volume_threshold: float = 3.0) -> DataFrame:
    """Alerts out of the results of ``anomaly_step``."""
    high = {"z_alert": F.abs("price_zscore") > z_threshold, "volume_alert": F.col("volume_ratio") > volume_threshold}
    marked = results.filter("not late").withColumns({c: F.coalesce(v, F.lit(False)) for c, v in high.items()})
    return marked.filter("z_alert or volume_alert").select(*KEYS, TIME, "price_zscore", "volume_ratio", "z_alert", "volume_alert")
