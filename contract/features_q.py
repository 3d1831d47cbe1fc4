"""Feature queries (hourly bars of all events) and their SQL."""

from __future__ import annotations

from contract.common import BARS_1H, W, frame, out, rolled, rsql
from wickframe.operators import features as f
from wickframe.plans import ingest
from wickframe.schema import OHLCV, SERIES, TIME
from wickframe.sources.adapters import bars_1h, dirty_bars

KEY = [*SERIES, TIME]


def feature(op, cols, **kw):
    return lambda spark, sf: out(op(bars_1h(spark, sf), **kw).select(*KEY, *cols))


QUERIES = {
    "returns": feature(f.returns, ["return_pct", "log_return"]),
    "moving_averages": feature(f.moving_averages, ["ma_7", "ma_25", "ma_99"]),
    "ema": feature(f.ema, ["ema_12", "ema_26"]),
    "macd": feature(f.macd, ["macd", "macd_signal", "macd_hist"]),
    "rsi_wilder": feature(f.rsi_wilder, ["rsi_14"]),
    "rsi_simple": feature(f.rsi_simple, ["rsi_14"]),
    "bollinger": feature(f.bollinger, ["bb_mid", "bb_upper", "bb_lower", "bb_width", "bb_pct"]),
    "true_range": feature(f.true_range, ["true_range"]),
    "atr_wilder": feature(f.atr_wilder, ["atr_14"]),
    "atr_simple": feature(f.atr_simple, ["atr_14"]),
    "volume_features": feature(f.volume_features, ["volume_ma_20", "volume_ratio"]),
    "rolling_vol": feature(f.rolling_vol, ["rolling_vol_30"]),
    "price_zscore": feature(f.price_zscore, ["price_zscore"]),
    "drawdown": feature(f.drawdown, ["drawdown_pct"]),
    "trend_regime": feature(f.trend_regime, ["regime"]),
    "vol_regime": feature(f.vol_regime, ["vol_regime"]),
    "calendar_parts": lambda spark, sf: out(f.calendar_parts(bars_1h(spark, sf)).drop(*OHLCV)),
    "encode_cyclical": lambda spark, sf: out(
        f.encode_cyclical(f.calendar_parts(bars_1h(spark, sf))).select(*KEY, *[c for c in f.FEATURES if c.endswith(("_sin", "_cos"))])
    ),
    "drop_warmup": lambda spark, sf: out(
        f.drop_warmup(f.bollinger(f.rsi_wilder(f.macd(bars_1h(spark, sf))))).select(*KEY, *f.CORE)
    ),
    "engineer_features": lambda spark, sf: out(f.engineer_features(bars_1h(spark, sf))),
    "clean_and_engineer": lambda spark, sf: out(ingest.clean_and_engineer(dirty_bars(spark, sf))[0]),
    "features_dashboard": lambda spark, sf: out(f.features_dashboard(bars_1h(spark, sf))),
    "features_serve": lambda spark, sf: out(f.features_serve(_partly_filled(spark, sf))),
    "ffill_zero": lambda spark, sf: out(
        f.ffill_zero(f.moving_averages(_holes(bars_1h(spark, sf))), ["close", "volume", "ma_7"]).select(*KEY, "close", "volume", "ma_7")
    ),
}


def _holes(df):
    from pyspark.sql import functions as F

    h = F.hour(TIME)
    return df.withColumns({"close": F.when(F.pmod(h, F.lit(5)) != 0, F.col("close")), "volume": F.when(h < 12, F.col("volume"))})


def _partly_filled(spark, sf):
    """Bars with a complete ``ma_7`` for some series, none for the others, and an extra column."""
    from pyspark.sql import functions as F

    b = bars_1h(spark, sf)
    return b.withColumns(
        {
            "ma_7": F.when((F.col("symbol") < "f") & (F.hour(TIME) != 3), F.col("open")),
            "note": F.when(F.hour(TIME) < 6, F.col("high")),
        }
    )


BASE = f"bars as ({BARS_1H})"


def features_cte(src: str = "bars", warm: str = "") -> str:
    """SQL of the training features: plain windows, and one recursion for all weighted means."""
    rec = {"e12": ("close", 2 / 13), "e26": ("close", 2 / 27), "g": ("gain", 1 / 14), "l": ("loss", 1 / 14), "a": ("tr", 1 / 14)}
    first = ", ".join(f"{x} as {n}" for n, (x, _) in rec.items())
    step = ", ".join(f"{a!r}::double * b.{x} + (1 - {a!r}::double) * e.{n} as {n}" for n, (x, a) in rec.items())
    sig_a = 0.2
    return f"""
 f0 as (select *, lag(close) over {W} as pc, row_number() over {W} - 1 as rn from {src}),
 f1 as (select *, case when close > pc then close - pc else 0.0 end as gain,
               case when close < pc then pc - close else 0.0 end as loss,
               greatest(high - low, coalesce(abs(high - pc), high - low), coalesce(abs(low - pc), high - low)) as tr,
               (close / pc - 1) * 100 as return_pct, ln(close / pc) as log_return,
               max(close) over {W} as peak
        from f0),
 fe as (select symbol, timeframe, rn, {first}, 0.0::double as sig from f1 where rn = 0
        union all
        select symbol, timeframe, rn, e12, e26, g, l, a,
               {sig_a}::double * (e12 - e26) + (1 - {sig_a}::double) * sig
        from (select b.symbol, b.timeframe, b.rn, {step}, e.sig
              from fe e join f1 b on b.symbol = e.symbol and b.timeframe = e.timeframe and b.rn = e.rn + 1)),
 f2 as (select b.*, e.e12 as ema_12, e.e26 as ema_26, e.e12 - e.e26 as macd, e.sig as macd_signal,
               e.e12 - e.e26 - e.sig as macd_hist, 100 - 100 / (1 + e.g / nullif(e.l, 0)) as rsi_14, e.a as atr_14
        from f1 b join fe e using (symbol, timeframe, rn)),
 f3 as (select *, {rolled('avg', 'close', 7)} as ma_7, {rolled('avg', 'close', 25)} as ma_25,
               {rolled('avg', 'close', 99)} as ma_99, {rolled('avg', 'close', 20)} as bb_mid,
               {rolled('stddev_samp', 'close', 20)} as sd20,
               {rolled('avg', 'volume', 20)} as volume_ma_20,
               {rolled('stddev_samp', 'log_return', 30)} * sqrt(8760.0::double) as rolling_vol_30,
               (close - {rolled('avg', 'close', 60)}) / nullif({rolled('stddev_samp', 'close', 60)}, 0) as price_zscore,
               (close - peak) / peak * 100 as drawdown_pct
        from f2),
 fq as (select symbol, timeframe, quantile_cont(atr_14, 0.33::double) as q33, quantile_cont(atr_14, 0.66::double) as q66
        from f3 group by 1, 2),
 features as (select f3.*, bb_mid + 2 * sd20 as bb_upper, bb_mid - 2 * sd20 as bb_lower,
               4 * sd20 / bb_mid as bb_width, (close - (bb_mid - 2 * sd20)) / nullif(4 * sd20, 0) as bb_pct,
               volume / nullif(volume_ma_20, 0) as volume_ratio,
               case when ma_7 > ma_25 and ma_25 > ma_99 then 'Bull' when ma_7 < ma_25 and ma_25 < ma_99 then 'Bear' else 'Sideways' end as regime,
               case when atr_14 >= q66 then 'High' when atr_14 <= q33 then 'Low' else 'Mid' end as vol_regime,
               isodow(open_time) - 1 as day_of_week, hour(open_time) as hour, month(open_time) as month,
               year(open_time) as year, day(open_time) as day_of_month, dayofyear(open_time) as day_of_year
        from f3 join fq using (symbol, timeframe))"""


def cyc(prefix, col, period, first):
    a = f"2 * pi() * ({col} - {first}) / {float(period)!r}::double"
    return {f"{prefix}_sin": f"sin({a})", f"{prefix}_cos": f"cos({a})"}


CYC = {k: v for s, p, x, o in f.CYCLES for k, v in cyc(x, s, p, o).items()}
CYC_SERVE = {k: v for s, p, x, o in f.SERVE_CYCLES for k, v in cyc(x, s, p, o).items()}
CAL = ["day_of_week", "hour", "month", "year", "day_of_month", "day_of_year"]
CALSQL = ", ".join(f"{c}::bigint as {c}" for c in CAL)
NUM = [c for c in f.FEATURES if c not in ("regime", "vol_regime", *CAL) and not c.endswith(("_sin", "_cos"))]
K = ", ".join(KEY)
OPEN = ", ".join(OHLCV)


def one(cols, cte=None, src=None):
    return f"with recursive {BASE}, {cte or features_cte()} select {K}, {rsql(cols)} from {src or 'features'}"


ALL = f"{K}, {rsql(list(OHLCV))}, {rsql(NUM)}, regime, vol_regime, {CALSQL}, {rsql(CYC)}"
CORE_ROWS = "rsi_14 is not null and macd is not null and bb_mid is not null"

PLAIN = f"""
 f0 as (select *, lag(close) over {W} as pc, row_number() over {W} - 1 as rn from bars)"""

DASH = f"""
 f0 as (select *, lag(close) over {W} as pc, row_number() over {W} - 1 as rn from bars),
 f1 as (select *, greatest(close - pc, 0 * pc) as up, greatest(pc - close, 0 * pc) as down,
               greatest(high - low, coalesce(abs(high - pc), high - low), coalesce(abs(low - pc), high - low)) as tr,
               (close / pc - 1) * 100 as return_pct, ln(close / pc) as log_return, max(close) over {W} as peak from f0),
 fe as (select symbol, timeframe, rn, close as e12, close as e26, 0.0::double as sig from f1 where rn = 0
        union all
        select symbol, timeframe, rn, e12, e26, 0.2::double * (e12 - e26) + 0.8::double * sig
        from (select b.symbol, b.timeframe, b.rn, (2.0::double / 13) * b.close + (11.0::double / 13) * e.e12 as e12,
                     (2.0::double / 27) * b.close + (25.0::double / 27) * e.e26 as e26, e.sig
              from fe e join f1 b on b.symbol = e.symbol and b.timeframe = e.timeframe and b.rn = e.rn + 1)),
 f2 as (select f1.*, e12 as ema_12, e26 as ema_26, e12 - e26 as macd, sig as macd_signal, e12 - e26 - sig as macd_hist,
               {rolled('avg', 'up', 14)} as mu, {rolled('avg', 'down', 14)} as md, {rolled('avg', 'tr', 14)} as atr_14,
               {rolled('avg', 'close', 7)} as ma_7, {rolled('avg', 'close', 25)} as ma_25,
               {rolled('avg', 'close', 20)} as bb_mid, {rolled('stddev_samp', 'close', 20)} as sd20,
               volume / ({rolled('avg', 'volume', 20)} + 1e-8::double) as volume_ratio,
               {rolled('stddev_samp', 'return_pct', 30)} as rolling_vol_30,
               (close - {rolled('avg', 'close', 30)}) / ({rolled('stddev_samp', 'close', 30)} + 1e-8::double) as price_zscore,
               (close - peak) / (peak + 1e-8::double) * 100 as drawdown_pct
        from f1 join fe using (symbol, timeframe, rn)),
 features as (select *, bb_mid + 2 * sd20 as bb_upper, bb_mid - 2 * sd20 as bb_lower,
               4 * sd20 / (bb_mid + 1e-8::double) as bb_width,
               (close - (bb_mid - 2 * sd20)) / (4 * sd20 + 1e-8::double) as bb_pct,
               100 - 100 / (1 + mu / (md + 1e-8::double)) as rsi_14,
               isodow(open_time) - 1 as day_of_week, hour(open_time) as hour, month(open_time) as month,
               dayofyear(open_time) as day_of_year from f2)"""

SERVE_COLS = [c for g in f.SERVE_GROUPS.values() for c in g]
SERVE_NUM = [c for c in SERVE_COLS if not c.endswith(("_sin", "_cos"))]

DIRTY = """raw as (select event_type as symbol, '1h' as timeframe, event_id as seq,
   case when event_id % 211 = 0 then null else date_trunc('hour', ts) end as open_time,
   case when event_id % 13 = 0 then null else value + 1.0::double end as open,
   case when event_id % 29 = 0 then 0.25::double else (value + 1.0::double) * 1.5::double end as high,
   case when event_id % 23 = 0 then 0.0::double else (value + 1.0::double) * 0.5::double end as low,
   case when event_id % 17 = 0 then 'Infinity'::double else (value + 1.0::double) * 1.25::double end as close,
   case when event_id % 19 = 0 then -1.0::double else (event_id % 97 + 1)::double end as volume
   from events)"""
CLEAN = DIRTY + """,
 nonnull as (select * from raw where open_time is not null and open is not null and high is not null and low is not null
             and close is not null and volume is not null),
 deduped as (select *, count(*) over (partition by symbol, timeframe, open_time) as copies from nonnull
             qualify row_number() over (partition by symbol, timeframe, open_time order by seq desc) = 1),
 labelled as (select *, case when isinf(open) or isinf(high) or isinf(low) or isinf(close) or isinf(volume) then 'inf'
             when not (open > 0 and high > 0 and low > 0 and close > 0 and volume >= 0) then 'non_positive'
             when not (high >= greatest(open, close, low) and low <= least(open, close, high)) then 'invalid_ohlc'
             else 'ok' end as label from deduped),
 clean as (select symbol, timeframe, open_time, open, high, low, close, volume from labelled where label = 'ok')"""

SQL = {
    "returns": one(["return_pct", "log_return"]),
    "moving_averages": one(["ma_7", "ma_25", "ma_99"]),
    "ema": one(["ema_12", "ema_26"]),
    "macd": one(["macd", "macd_signal", "macd_hist"]),
    "rsi_wilder": one(["rsi_14"]),
    "rsi_simple": one({"rsi_14": "100 - 100 / (1 + mu / (md + 1e-8::double))"}, DASH, "f2"),
    "bollinger": one(["bb_mid", "bb_upper", "bb_lower", "bb_width", "bb_pct"]),
    "true_range": one({"true_range": "tr"}),
    "atr_wilder": one(["atr_14"]),
    "atr_simple": one(["atr_14"], DASH),
    "volume_features": one(["volume_ma_20", "volume_ratio"]),
    "rolling_vol": one(["rolling_vol_30"]),
    "price_zscore": one(["price_zscore"]),
    "drawdown": one(["drawdown_pct"]),
    "trend_regime": f"with recursive {BASE}, {features_cte()} select {K}, regime from features",
    "vol_regime": f"with recursive {BASE}, {features_cte()} select {K}, vol_regime from features",
    "calendar_parts": f"with recursive {BASE}, {features_cte()} select {K}, {CALSQL} from features",
    "encode_cyclical": f"with recursive {BASE}, {features_cte()} select {K}, {rsql(CYC)} from features",
    "drop_warmup": f"with recursive {BASE}, {features_cte()} select {K}, {rsql(list(f.CORE))} from features where {CORE_ROWS}",
    "engineer_features": f"with recursive {BASE}, {features_cte()} select {ALL} from features where {CORE_ROWS}",
    "clean_and_engineer": f"with recursive {CLEAN}, {features_cte('clean')} select {ALL} from features where {CORE_ROWS}",
    "features_dashboard": f"with recursive {BASE}, {DASH} select {K}, {rsql(list(OHLCV))}, "
    + rsql({c: f"coalesce({c}, 0.0)" for c in f.DASHBOARD_FEATURES})
    + " from features",
    "features_serve": f"""with recursive {BASE}, {DASH},
 given as (select symbol, timeframe, open_time, case when symbol < 'f' and hour(open_time) <> 3 then open end as g_ma_7,
                  case when hour(open_time) < 6 then high end as note from bars),
 has as (select symbol, timeframe, count(g_ma_7) > 0 as has_ma from given group by 1, 2),
 j as (select features.*, case when has_ma then g_ma_7 else ma_7 end as m7, note
       from features join given using (symbol, timeframe, open_time) join has using (symbol, timeframe)),
 filled as (select *, last_value(m7 ignore nulls) over {W} as m7f, last_value(note ignore nulls) over {W} as notef from j)
 select {K}, {rsql(list(OHLCV))}, {rsql({c: f'coalesce({c}, 0.0)' for c in SERVE_NUM if c != 'ma_7'})},
 {rsql({'ma_7': 'coalesce(m7f, 0.0)', 'note': 'coalesce(notef, 0.0)'})}, {rsql({c: CYC_SERVE[c] for c in SERVE_COLS if c in CYC_SERVE})}
 from filled""",
    "ffill_zero": f"""with {BASE},
 h as (select symbol, timeframe, open_time, case when hour(open_time) % 5 <> 0 then close end as close,
              case when hour(open_time) < 12 then volume end as volume from bars),
 m as (select *, {rolled('avg', 'close', 7)} as ma_7 from h)
 select {K}, {rsql({c: f'coalesce(last_value({c} ignore nulls) over {W}, 0.0)' for c in ('close', 'volume', 'ma_7')})} from m""",
}
