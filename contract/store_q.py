"""Storage and cleaning queries and their SQL."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from contract.common import BARS_1D, BARS_1H, BARS_1M, BARS_SUPP, W, out, rsql
from contract.features_q import CLEAN, DIRTY
from wickframe.operators import clean as c
from wickframe.schema import OHLCV, SERIES, TIME
from wickframe.sources import klines, store
from wickframe.sources.adapters import bars_1d, bars_1h, bars_1m, bars_supp, dirty_bars, kline_batches, raw_candles

NOW = datetime(2024, 2, 1)
T0 = datetime(2024, 1, 31)


def stored(spark, sf):
    b = bars_1h(spark, sf).filter(F.col(TIME) < F.lit(datetime(2024, 1, 20)))
    return b.filter(F.col("symbol") != "view").withColumns({"created_at": F.lit(T0), "updated_at": F.lit(T0)})


def incoming(spark, sf):
    return bars_1h(spark, sf).filter(F.col(TIME) >= F.lit(datetime(2024, 1, 15))).withColumn("close", F.col("close") + 1)


def merged(spark, sf):
    return store.upsert_candles(stored(spark, sf), incoming(spark, sf), F.lit(NOW))


def _log(spark, sf):
    series = incoming(spark, sf).select(*SERIES).distinct()
    first = store.log_start(series, "incremental", F.lit(T0), "run-1")
    second = store.log_start(series, "incremental", F.lit(NOW), "run-2")
    done = store.log_finish(first, store.upsert_counts(merged(spark, sf)), F.lit(NOW))
    failed = store.log_finish(second.filter(F.col("symbol") == "error"), None, F.lit(datetime(2024, 2, 2)), "timeout")
    return store.audit_log(first.unionByName(second).unionByName(done).unionByName(failed))


def _ranges(spark, sf):
    s = bars_1h(spark, sf).groupBy("symbol").agg(F.min(TIME).alias("since"), F.max(TIME).alias("until"))
    return klines.plan_fetch_ranges(s, "1h", 50)


def _union(spark, sf):
    b = bars_1d(spark, sf)
    return store.union_series({s: b.filter(F.col("symbol") == s).drop("symbol") for s in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")})


def _records(spark, sf):
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="wickframe-")
    path = f"{base}/export-{uuid.uuid4().hex}"
    store.export_dataset(bars_1h(spark, sf), path)
    schema = "symbol string, timeframe string, open_time timestamp, open double, high double, low double, close double, volume double"
    return store.load_records(spark, f"{path}/records/split=train", schema, lines=True)


QUERIES = {
    "load_records": lambda s, d: out(_records(s, d)),
    "parse_klines": lambda s, d: out(klines.parse_klines(kline_batches(s, d))),
    "plan_fetch_ranges": lambda s, d: out(_ranges(s, d)),
    "read_candles": lambda s, d: out(store.read_candles(bars_1h(s, d), "click", "1h", datetime(2024, 1, 5), datetime(2024, 1, 9, 12))),
    "lookback_filter": lambda s, d: out(store.lookback_filter(bars_1d(s, d), datetime(2001, 8, 1), 365)),
    "latest_n": lambda s, d: out(store.latest_n(bars_1h(s, d), 30)),
    "latest_price": lambda s, d: out(store.latest_price(bars_1h(s, d))),
    "data_summary": lambda s, d: out(store.data_summary(bars_1h(s, d).withColumn("updated_at", F.lit(T0)))),
    "latest_timestamp": lambda s, d: out(store.latest_timestamp(bars_supp(s, d))),
    "upsert_candles": lambda s, d: out(merged(s, d)),
    "upsert_counts": lambda s, d: out(store.upsert_counts(merged(s, d))),
    "incremental_slice": lambda s, d: out(store.incremental_slice(bars_1h(s, d), stored(s, d))),
    "audit_log": lambda s, d: out(_log(s, d)),
    "union_series": lambda s, d: out(_union(s, d)),
    "chrono_split": lambda s, d: out(store.chrono_split(bars_1h(s, d))),
    "three_way_split": lambda s, d: out(store.three_way_split(bars_1h(s, d))),
    "export_dataset": lambda s, d: out(store.dataset_metadata(store.chrono_split(bars_1h(s, d)))),
    "normalize_columns": lambda s, d: out(c.normalize_columns(raw_candles(s, d), extra=("seq",))),
    "coerce_types": lambda s, d: out(dirty_bars(s, d)),
    "clean_candles": lambda s, d: out(c.clean_candles(dirty_bars(s, d))),
    "drop_nulls": lambda s, d: out(c.drop_nulls(dirty_bars(s, d))),
    "dedupe_candles": lambda s, d: out(c.dedupe_candles(c.drop_nulls(dirty_bars(s, d)), "first")),
    "drop_inf": lambda s, d: out(c.drop_inf(c.drop_nulls(dirty_bars(s, d)))),
    "drop_non_positive": lambda s, d: out(c.drop_non_positive(c.drop_nulls(dirty_bars(s, d)))),
    "valid_ohlc": lambda s, d: out(c.valid_ohlc(c.drop_nulls(dirty_bars(s, d)))),
    "cleaning_report": lambda s, d: out(c.cleaning_report(dirty_bars(s, d))),
    "detect_gaps": lambda s, d: out(c.detect_gaps(bars_1m(s, d))),
    "gap_count": lambda s, d: out(c.gap_count(bars_supp(s, d))),
}

B1H, B1D = f"with bars as ({BARS_1H})", f"with bars as ({BARS_1D})"
STORED = f"""{B1H}, stored as (select *, timestamp '2024-01-31' as created_at, timestamp '2024-01-31' as updated_at from bars
 where open_time < timestamp '2024-01-20' and symbol <> 'view'),
 incoming as (select symbol, timeframe, open_time, open, high, low, close + 1 as close, volume from bars where open_time >= timestamp '2024-01-15'),
 merged as (select coalesce(n.symbol, o.symbol) as symbol, coalesce(n.timeframe, o.timeframe) as timeframe,
   coalesce(n.open_time, o.open_time) as open_time,
   {', '.join(f'case when n.symbol is not null then n.{x} else o.{x} end as {x}' for x in OHLCV)},
   coalesce(o.created_at, timestamp '2024-02-01') as created_at,
   case when n.symbol is not null then timestamp '2024-02-01' else o.updated_at end as updated_at,
   case when n.symbol is null then 'keep' when o.symbol is null then 'insert' else 'update' end as action
   from stored o full join incoming n on o.symbol = n.symbol and o.timeframe = n.timeframe and o.open_time = n.open_time),
 counts as (select symbol, timeframe, count(*) filter (action = 'insert') as rows_inserted,
   count(*) filter (action = 'update') as rows_updated from merged group by 1, 2)"""
V = rsql(list(OHLCV))
CANDLE = f"symbol, timeframe, open_time, {V}"
NONNULL = " and ".join(f"{x} is not null" for x in (TIME, *OHLCV))
RAW = f"with {DIRTY}, n as (select * from raw where {NONNULL})"
ISINF = " or ".join(f"isinf({x})" for x in OHLCV)
NUMBERED = f"{B1H}, n as (select *, row_number() over {W} - 1 as rn, count(*) over (partition by symbol, timeframe) as n from bars)"
GAPS = """, g as (select symbol, timeframe, lag(open_time) over (partition by symbol, timeframe order by open_time) as gap_start,
  open_time as gap_end from bars), gaps as (select *, round(epoch_ms(gap_end - gap_start) / {step}.0)::bigint - 1 as missing from g
  where epoch_ms(gap_end - gap_start) > {step} * 1.5)"""
TXT = {
    "open": ("value + 1.0::double", 13, "bad"),
    "high": ("(value + 1.0::double) * 1.5::double", 29, "0.25"),
    "low": ("(value + 1.0::double) * 0.5::double", 23, "0.0"),
    "close": ("(value + 1.0::double) * 1.25::double", 17, "Infinity"),
    "volume": ("(event_id % 97 + 1)::double", 19, "-1.0"),
}

SQL = {
    "load_records": f"{NUMBERED} select {CANDLE} from n where rn < floor(n * 0.85::double)",
    "parse_klines": f"{B1H} select {CANDLE} from bars",
    "plan_fetch_ranges": f"""{B1H}, s as (select symbol, epoch_ms(min(open_time)) as a, epoch_ms(max(open_time)) as z from bars group by 1),
      p as (select symbol, a, z, unnest(range(0, (z - a + 179999999) // 180000000)) as page from s)
      select symbol, '1h' as timeframe, page::bigint as page, a + page * 180000000 as start_ms, least(a + (page + 1) * 180000000, z) - 1 as end_ms from p""",
    "read_candles": f"{B1H} select open_time, {V} from bars where symbol = 'click' and open_time between timestamp '2024-01-05' and timestamp '2024-01-09 12:00:00'",
    "lookback_filter": f"{B1D} select {CANDLE} from bars where open_time >= timestamp '2001-08-01' - interval 365 days",
    "latest_n": f"{B1H} select {CANDLE} from bars qualify row_number() over (partition by symbol, timeframe order by open_time desc) <= 30",
    "latest_price": f"{B1H} select {CANDLE} from bars qualify row_number() over (partition by symbol, timeframe order by open_time desc) = 1",
    "data_summary": f"{B1H} select symbol, timeframe, count(*) as total_rows, min(open_time) as earliest, max(open_time) as latest, timestamp '2024-01-31' as last_updated from bars group by 1, 2",
    "latest_timestamp": f"with bars as ({BARS_SUPP}) select symbol, timeframe, max(open_time) as latest from bars group by 1, 2",
    "upsert_candles": f"{STORED} select {CANDLE}, created_at, updated_at, action from merged",
    "upsert_counts": f"{STORED} select * from counts",
    "incremental_slice": f"""{STORED}, m as (select symbol, timeframe, max(open_time) as latest from stored group by 1, 2)
      select {CANDLE.replace('symbol, timeframe', 'bars.symbol, bars.timeframe')}, case when latest is null then 'initial' else 'incremental' end as mode from bars
      left join m on bars.symbol = m.symbol and bars.timeframe = m.timeframe where latest is null or open_time >= latest + interval 1 second""",
    "audit_log": f"""{STORED}, s as (select distinct symbol, timeframe from incoming)
      select 'run-1' as run_id, symbol, timeframe, 'incremental' as mode, timestamp '2024-01-31' as started_at, timestamp '2024-02-01' as finished_at,
             coalesce(rows_inserted, 0) as rows_inserted, coalesce(rows_updated, 0) as rows_updated, 'success' as status, null::varchar as error_message
      from s left join counts using (symbol, timeframe)
      union all select 'run-2', symbol, timeframe, 'incremental', timestamp '2024-02-01', case when symbol = 'error' then timestamp '2024-02-02' end, 0, 0,
             case when symbol = 'error' then 'error' else 'running' end, case when symbol = 'error' then 'timeout' end from s""",
    "union_series": f"{B1D} select {CANDLE} from bars",
    "chrono_split": f"{NUMBERED} select {CANDLE}, case when rn < floor(n * 0.85::double) then 'train' else 'test' end as split from n",
    "three_way_split": f"{NUMBERED} select {CANDLE}, case when rn < floor(floor(n * 0.85::double) * 0.85::double) then 'train' when rn < floor(n * 0.85::double) then 'calibration' else 'test' end as split from n",
    "export_dataset": f"""{NUMBERED}, x as (select *, rn < floor(n * 0.85::double) as tr from n)
      select symbol, timeframe, count(*) as total_rows, count(*) filter (tr) as train_rows, count(*) filter (not tr) as test_rows, 8::bigint as n_features,
      min(open_time) as start, max(open_time) as "end", max(open_time) filter (tr) as train_end, min(open_time) filter (not tr) as test_start from x group by 1, 2""",
    "normalize_columns": "select event_type as symbol, '1h' as timeframe, event_id as seq, case when event_id % 211 = 0 then 'not a time' "
    "else strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') end as open_time, "
    + ", ".join(f"case when event_id % {k} = 0 then '{bad}' else ({x})::varchar end as {n}" for n, (x, k, bad) in TXT.items())
    + " from events",
    "coerce_types": f"with {DIRTY} select symbol, timeframe, seq, open_time, {V} from raw",
    "clean_candles": f"with {CLEAN} select {CANDLE} from clean",
    "drop_nulls": f"{RAW} select symbol, timeframe, seq, open_time, {V} from n",
    "dedupe_candles": f"{RAW} select symbol, timeframe, seq, open_time, {V} from n qualify row_number() over (partition by symbol, timeframe, open_time order by seq) = 1",
    "drop_inf": f"{RAW} select symbol, timeframe, seq, open_time, {V} from n where not ({ISINF})",
    "drop_non_positive": f"{RAW} select symbol, timeframe, seq, open_time, {V} from n where open > 0 and high > 0 and low > 0 and close > 0 and volume >= 0",
    "valid_ohlc": f"{RAW} select symbol, timeframe, seq, open_time, {V} from n where high >= greatest(open, close, low) and low <= least(open, close, high)",
    "cleaning_report": f"""with {CLEAN}, i as (select symbol, timeframe, count(*) as rows_in, count(*) filter (not ({NONNULL})) as dropped_nulls from raw group by 1, 2),
      l as (select symbol, timeframe, sum(copies - 1)::bigint as dropped_duplicates, count(*) filter (label = 'inf') as dropped_inf,
        count(*) filter (label = 'non_positive') as dropped_non_positive, count(*) filter (label = 'invalid_ohlc') as dropped_invalid_ohlc,
        count(*) filter (label = 'ok') as rows_out from labelled group by 1, 2),
      d as (select symbol, timeframe, epoch_ms(open_time - lag(open_time) over {W}) as ms from clean),
      g as (select symbol, timeframe, count(*) filter (ms > 3600000 * 1.5) as gap_count from d group by 1, 2)
      select i.symbol, i.timeframe, rows_in, rows_out, dropped_nulls, dropped_duplicates, dropped_invalid_ohlc, dropped_non_positive, dropped_inf, gap_count,
        rows_in - rows_out as rows_removed, case when gap_count > 0 then 'Detected ' || gap_count || ' missing candle interval(s)' else '' end as notes
      from i join l using (symbol, timeframe) join g using (symbol, timeframe)""",
    "detect_gaps": f"with bars as ({BARS_1M}){GAPS.format(step=60000)} select symbol, timeframe, gap_start, gap_end, missing from gaps",
    "gap_count": f"with bars as ({BARS_SUPP}){GAPS.format(step=86400000)}, s as (select distinct symbol, timeframe from bars), "
    "c as (select symbol, timeframe, count(*) as gap_count, sum(missing)::bigint as missing_candles from gaps group by 1, 2) "
    "select symbol, timeframe, coalesce(gap_count, 0) as gap_count, coalesce(missing_candles, 0) as missing_candles from s left join c using (symbol, timeframe)",
}
