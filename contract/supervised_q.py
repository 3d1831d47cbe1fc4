"""Supervised-set queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.common import BARS_1D, BARS_1H, W, frame, out, rolled, rsql
from wickframe.operators import supervised as s
from wickframe.schema import OHLCV, SERIES, TIME
from wickframe.sources.adapters import bars_1d, bars_1h

KEY = [*SERIES, TIME]
K = "symbol, timeframe, open_time"
LAG = {f"close_lag_{k}": f"lag(close, {k}) over {W}" for k in s.LAGS}
ROLL = {}
for n in s.ROLLS:
    ROLL[f"close_roll_mean_{n}"] = rolled("avg", "close", n, n // 2)
    ROLL[f"close_roll_std_{n}"] = rolled("stddev_samp", "close", n, n // 2)
    if n <= 14:
        ROLL[f"close_roll_min_{n}"] = rolled("min", "close", n, n // 2)
        ROLL[f"close_roll_max_{n}"] = rolled("max", "close", n, n // 2)
DIFF = {
    "close_diff_1": f"close - lag(close) over {W}",
    "close_diff_7": f"close - lag(close, 7) over {W}",
    "close_mom_7": f"close - lag(close, 7) over {W}",
}
BASE = f"bars as ({BARS_1H}), n as (select *, row_number() over {W} - 1 as rn, count(*) over (partition by symbol, timeframe) as n from bars)"
EW = """, e as (select symbol, timeframe, rn, close as close_ewma_7, close as close_ewma_14 from n where rn = 0 union all
  select n.symbol, n.timeframe, n.rn, 0.25::double * n.close + 0.75::double * e.close_ewma_7,
    (2.0::double / 15) * n.close + (13.0::double / 15) * e.close_ewma_14 from e join n on n.symbol = e.symbol and n.timeframe = e.timeframe and n.rn = e.rn + 1)"""
EWC = ["close_ewma_7", "close_ewma_14"]


def sel(cols):
    return ", ".join(f"{x} as {n}" for n, x in cols.items())


def _windows(spark, sf):
    def text(c):
        return F.array_join(F.transform(c, lambda x: F.round(x * 100).cast("bigint").cast("string")), ",")

    w = s.sequence_windows(bars_1h(spark, sf))
    return w.select(*KEY, F.size("encoder").alias("n_encoder"), text("encoder").alias("encoder"), text("decoder").alias("decoder"))


def _normalized(spark, sf):
    w = s.encoder_normalize(s.sequence_windows(bars_1h(spark, sf)))
    return w.select(
        *KEY, "center", "scale", F.element_at("encoder", -1).alias("last_encoder"), F.element_at("decoder", 1).alias("first_decoder"),
        F.element_at("decoder", -1).alias("last_decoder"),
    )


def _untidy(spark, sf):
    b = bars_1h(spark, sf)
    return b.select(
        "symbol",
        F.when(F.hour(TIME) != 4, F.date_format(TIME, "yyyy-MM-dd HH:mm:ss")).otherwise("?").alias(TIME),
        F.when(F.hour(TIME) % 3 != 0, F.col("close")).alias("close"),
        F.when(F.col("volume") > 1, F.col("volume")).alias("volume"),
    )


QUERIES = {
    "lag_features": lambda x, d: out(s.lag_features(bars_1h(x, d)).select(*KEY, *LAG)),
    "rolling_features": lambda x, d: out(s.rolling_features(bars_1h(x, d)).select(*KEY, *ROLL)),
    # shifted by 1e-8: quarter steps of two-decimal values lie exactly on rounding ties
    "ewma_features": lambda x, d: out(s.ewma_features(bars_1h(x, d)).select(*KEY, *[(F.col(c) + 1e-8).alias(c) for c in EWC])),
    "diff_momentum": lambda x, d: out(s.diff_momentum(bars_1h(x, d)).select(*KEY, *DIFF)),
    "build_lag_features": lambda x, d: out(s.build_lag_features(bars_1h(x, d))),
    "make_supervised": lambda x, d: out(s.make_supervised(bars_1h(x, d))),
    "future_return": lambda x, d: out(s.future_return(bars_1d(x, d)).select(*KEY, "future_return")),
    "time_index": lambda x, d: out(s.time_index(bars_1h(x, d)).select(*KEY, "time_idx")),
    "sequence_windows": lambda x, d: out(_windows(x, d)),
    "encoder_normalize": lambda x, d: out(_normalized(x, d)),
    "prepare_series": lambda x, d: out(s.prepare_series(_untidy(x, d), timeframe="1h")),
    "time_series_folds": lambda x, d: out(s.time_series_folds(bars_1h(x, d)).select(*KEY, "fold")),
    "walk_forward_folds": lambda x, d: out(s.walk_forward_folds(bars_1h(x, d))),
}

WIN = f"""with {BASE}, w as (select symbol, timeframe, open_time, list(close) over {frame(30)} as enc,
  list(close) over (partition by symbol, timeframe order by open_time rows between 1 following and 7 following) as dec from bars),
  k as (select * from w where len(enc) >= 15 and len(coalesce(dec, [])) >= 1)"""
SQL = {
    "lag_features": f"with {BASE} select {K}, {rsql(LAG)} from bars",
    "rolling_features": f"with {BASE} select {K}, {rsql(ROLL)} from bars",
    "ewma_features": f"with recursive {BASE}{EW} select n.symbol, n.timeframe, open_time, {rsql({c: f'{c} + 1e-8::double' for c in EWC})} from n join e on n.symbol = e.symbol and n.rn = e.rn",
    "diff_momentum": f"with {BASE} select {K}, {rsql(DIFF)} from bars",
    "build_lag_features": f"""with recursive {BASE}{EW}, f as (select n.*, {sel(LAG)}, {sel(ROLL)}, {sel(DIFF)} from n)
      select f.symbol, f.timeframe, f.open_time, {rsql(list(OHLCV))}, {rsql(list(LAG))}, {rsql(list(ROLL))}, {rsql(EWC)}, {rsql(list(DIFF))}
      from f join e on f.symbol = e.symbol and f.rn = e.rn where close_lag_21 is not null""",
    "make_supervised": f"with {BASE} select {K}, round(open, 6) as open, round(high, 6) as high, round(low, 6) as low, round(volume, 6) as volume, round(lead(close) over {W}, 6) as y from bars qualify y is not null",
    "future_return": f"with bars as ({BARS_1D}) select {K}, round(ln(lead(close) over {W} / close), 6) as future_return from bars",
    "time_index": f"with {BASE} select {K}, rn as time_idx from n",
    "sequence_windows": f"{WIN} select {K}, len(enc) as n_encoder, array_to_string([round(x * 100)::bigint for x in enc], ',') as encoder, array_to_string([round(x * 100)::bigint for x in dec], ',') as decoder from k",
    "encoder_normalize": f"""{WIN}, z as (select *, list_avg(enc) as c, list_stddev_pop(enc) + 1e-8::double as s from k)
      select {K}, round(c, 6) as center, round(s, 6) as scale, round((enc[-1] - c) / s, 6) as last_encoder, round((dec[1] - c) / s, 6) as first_decoder,
      round((dec[-1] - c) / s, 6) as last_decoder from z""",
    "prepare_series": f"""with {BASE}, u as (select symbol, timeframe, open_time, case when hour(open_time) % 3 <> 0 then close end as close,
        case when volume > 1 then volume end as volume from bars where hour(open_time) <> 4)
      select {K}, {rsql({c: f'coalesce(last_value({c} ignore nulls) over {W}, 0.0)' for c in ('close', 'volume')})} from u""",
    "time_series_folds": f"with {BASE} select {K}, case when rn >= n - 5 * (n // 6) then (rn - (n - 5 * (n // 6))) // (n // 6) + 1 else 0 end::bigint as fold from n",
    "walk_forward_folds": f"""with {BASE}, c as (select symbol, timeframe, count(*) as n from bars group by 1, 2),
      k as (select *, case when (n - 90) // 5 < 7 then greatest(2, (n - 90) // 7) else 5 end as k from c where n > 90),
      f as (select *, (n - 90) // k as size, unnest(range(0, k)) as f from k),
      g as (select *, 90 + f * size as a, least(90 + f * size + size, n) as z from f)
      select symbol, timeframe, f + 1 as fold, a as train_rows, a - 1 as train_end_idx, greatest(0, a - 30) as context_start_idx, a as val_start_idx,
      z - 1 as val_end_idx, z - greatest(0, a - 30) as val_rows from g where z < n""",
}
