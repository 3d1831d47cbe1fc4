"""Streaming queries, run to completion over the given tables, and their batch SQL."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from contract.common import BARS_1H, BARS_1M, W, out, rsql
from contract.features_q import BASE, CLEAN, DIRTY, features_cte
from contract.store_q import GAPS
from wickframe.schema import CANDLE, OHLCV, SERIES, TIME
from wickframe.sources import store
from wickframe.sources.adapters import bars_1h, bars_1m, dirty_bars
from wickframe.streaming import candles as s
from wickframe.streaming import carried


def scratch(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="wickframe-")
    return f"{base}/stream-{uuid.uuid4().hex}"


def replay(spark, df, path):
    """A stream over the rows of ``df``, written to files first."""
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def through(spark, make, df=None, source=None):
    d = scratch(spark)
    s.run_to_files(make(source if source is not None else replay(spark, df, f"{d}/in")), f"{d}/out", f"{d}/cp")
    return spark.read.parquet(f"{d}/out")


def through_carried(spark, df, step, parts=3):
    """Results of a stream that gets the rows of ``df`` in time order, in ``parts`` runs that go on from each other's state."""
    d = scratch(spark)
    ms = F.unix_millis(TIME)
    low, high = df.agg(F.min(ms), F.max(ms)).first()
    for i in range(parts):
        part = F.lit(True) if low is None else F.floor((ms - low) * parts / (high - low + 1)) == i
        df.filter(part).write.mode("append").parquet(f"{d}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{d}/in")
        carried.run_carried(stream, step, f"{d}/out", f"{d}/state", f"{d}/cp")
    return spark.read.option("mergeSchema", "true").parquet(f"{d}/out").drop("batch")


def events(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _latest(spark, sf):
    d = scratch(spark)
    stream = s.stream_latest(replay(spark, bars_1h(spark, sf), f"{d}/in"))

    def save(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{d}/out/batch={batch_id}")

    stream.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", f"{d}/cp").trigger(availableNow=True).start().awaitTermination()
    return store.latest_price(spark.read.schema(CANDLE).parquet(f"{d}/out"))


def _upsert(spark, sf):
    d = scratch(spark)
    store.init_store(spark, f"{d}/table")
    s.stream_upsert(replay(spark, dirty_bars(spark, sf), f"{d}/in"), f"{d}/table", f"{d}/log", f"{d}/tmp", f"{d}/cp").awaitTermination()
    return store.read_store(spark, f"{d}/table").select(*SERIES, TIME, *OHLCV)


IND = ["ema_12", "ema_26", "macd", "macd_signal", "macd_hist", "rsi_14", "atr_14", "drawdown_pct"]
QUERIES = {
    "stream_bars": lambda x, d: out(through(x, s.stream_bars, source=events(x, d))),
    "stream_clean": lambda x, d: out(through(x, s.stream_clean, dirty_bars(x, d)).select(*SERIES, TIME)),
    "stream_upsert": lambda x, d: out(_upsert(x, d)),
    "stream_indicators": lambda x, d: out(through_carried(x, bars_1h(x, d), carried.indicators_step()).select(*SERIES, TIME, "late", *IND)),
    "stream_gaps": lambda x, d: out(carried.gaps(through_carried(x, bars_1m(x, d), carried.gaps_step()))),
    "stream_anomaly": lambda x, d: out(carried.alerts(through_carried(x, bars_1h(x, d), carried.anomaly_step()))),
    "stream_latest": lambda x, d: out(_latest(x, d)),
}


GOODROW = "open > 0 and high > 0 and low > 0 and close > 0 and volume >= 0 and not isinf(close) and high >= greatest(open, close, low) and low <= least(open, close, high)"
SQL = {
    "stream_bars": f"with bars as ({BARS_1H}) select symbol, timeframe, open_time, {rsql(list(OHLCV))} from bars where open_time + interval 1 hour <= (select max(ts) from events) - interval 1 hour",
    "stream_clean": f"with {DIRTY} select distinct symbol, timeframe, open_time from raw where open_time is not null and open is not null and {GOODROW}",
    "stream_upsert": f"with {CLEAN} select symbol, timeframe, open_time, {rsql(list(OHLCV))} from clean",
    "stream_indicators": f"with recursive {BASE}, {features_cte()} select symbol, timeframe, open_time, false as late, {rsql(IND)} from features",
    "stream_gaps": f"with bars as ({BARS_1M}){GAPS.format(step=60000)} select symbol, timeframe, gap_start, gap_end, missing from gaps",
    "stream_anomaly": f"with recursive {BASE}, {features_cte()} select symbol, timeframe, open_time, {rsql(['price_zscore', 'volume_ratio'])}, coalesce(abs(price_zscore) > 3, false) as z_alert, "
    "coalesce(volume_ratio > 3, false) as volume_alert from features where abs(price_zscore) > 3 or volume_ratio > 3",
    "stream_latest": f"with bars as ({BARS_1H}) select symbol, timeframe, open_time, {rsql(list(OHLCV))} from bars qualify row_number() over {W} = count(*) over (partition by symbol, timeframe)",
}
