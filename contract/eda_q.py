"""Exploratory queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.common import BARS_1D, BARS_1H, BARS_SUPP, S, W, frame, out, rolled, rsql
from contract.features_q import BASE, CYC, features_cte
from wickframe.operators import eda as e
from wickframe.operators import features as f
from wickframe.operators.supervised import future_return
from wickframe.schema import OHLCV, SERIES, TIME
from wickframe.sources.adapters import bars_1d, bars_1h, bars_supp

KEY = [*SERIES, TIME]
K2, K = "symbol, timeframe", "symbol, timeframe, open_time"
CYCLIC = [c for c in CYC if not c.startswith("dom")]
MI = [*e.ANALYTICAL, *CYCLIC]
CORR = list(e.ANALYTICAL)
STABLE = list(e.STABILITY)
A, B = "click", "purchase"


def feats(spark, sf, *defs):
    return f.with_indicators(bars_1h(spark, sf), list(defs) or f.train_indicators())


def rets(spark, sf):
    return f.returns(bars_1d(spark, sf))


def _mi(spark, sf):
    b = f.with_indicators(bars_1h(spark, sf), f.train_indicators())
    return e.mutual_information(f.encode_cyclical(f.calendar_parts(future_return(b))), MI)


QUERIES = {
    "price_snapshot": lambda x, d: out(e.price_snapshot(bars_1d(x, d))),
    "kpi_latest": lambda x, d: out(e.kpi_latest(feats(x, d, f.rsi_wilder_def(), f.macd_def()))),
    "candle_direction": lambda x, d: out(e.candle_direction(bars_1h(x, d)).drop(*OHLCV)),
    "candle_window": lambda x, d: out(e.candle_window(bars_1d(x, d))),
    "band_breakouts": lambda x, d: out(e.band_breakouts(feats(x, d, f.bollinger_def())).select(*KEY, "close", "bb_upper", "bb_lower", "side")),
    "rsi_zones": lambda x, d: out(e.rsi_zones(feats(x, d, f.rsi_wilder_def())).select(*KEY, "overbought", "oversold", "zone")),
    "cumulative_return": lambda x, d: out(e.cumulative_return(rets(x, d)).select(*KEY, "cumulative_return")),
    "seasonality_dow": lambda x, d: out(e.seasonality_dow(rets(x, d))),
    "seasonality_dow_hour": lambda x, d: out(e.seasonality_dow_hour(f.returns(bars_1h(x, d)))),
    "seasonality_year_month": lambda x, d: out(e.seasonality_year_month(rets(x, d))),
    "anomaly_zscore": lambda x, d: out(e.anomaly_zscore(feats(x, d, f.price_zscore_def())).select(*KEY, "close", "price_zscore", "side")),
    "anomaly_counts": lambda x, d: out(e.anomaly_counts(feats(x, d, f.price_zscore_def(), f.volume_def()))),
    "anomaly_volume_spike": lambda x, d: out(e.anomaly_volume_spike(f.with_indicators(bars_supp(x, d), [f.volume_def()])).select(*KEY, "volume", "volume_ratio")),
    "regime_share": lambda x, d: out(e.regime_share(f.trend_regime(bars_1h(x, d)))),
    "vol_regime_share": lambda x, d: out(e.regime_share(f.vol_regime(bars_1h(x, d)), "vol_regime")),
    "symbol_correlation": lambda x, d: out(e.symbol_correlation(f.returns(bars_1h(x, d)), A, B)),
    "mean_correlation": lambda x, d: out(e.mean_correlation(e.symbol_correlation(f.returns(bars_1h(x, d)), A, B))),
    "beta_regression": lambda x, d: out(e.beta_regression(f.returns(bars_1h(x, d)), A, B, p_value=False)),
    "beta_p_value": lambda x, d: out(e.beta_regression(f.returns(bars_1h(x, d)), A, B)),
    "correlation_matrix": lambda x, d: out(e.correlation_matrix(feats(x, d))),
    "mutual_information": lambda x, d: out(_mi(x, d)),
    "feature_stability": lambda x, d: out(e.feature_stability(feats(x, d))),
    "vif": lambda x, d: out(e.vif(feats(x, d))),
}

D = f"with bars as ({BARS_1D}), r as (select *, (close / lag(close) over {W} - 1) * 100 as ret from bars)"
H = f"with bars as ({BARS_1H}), r as (select *, (close / lag(close) over {W} - 1) * 100 as ret, ln(close / lag(close) over {W}) as lr from bars)"
FT = f"with recursive {BASE}, {features_cte()}"
PAIR = f"""{H}, p as (select 'click|purchase' as symbol, a.timeframe, a.open_time, a.close as ca, b.close as cb, a.lr as ra, b.lr as rb
  from r a join r b on a.open_time = b.open_time and a.symbol = '{A}' and b.symbol = '{B}'),
  c as (select *, case when count(case when ra is not null and rb is not null then 1 end) over {frame(30)} >= 30 then corr(ra, rb) over {frame(30)} end as rc,
    first_value(ca) over {W} as fa, first_value(cb) over {W} as fb from p)"""
PAIRS = ", ".join(f"('{a}', '{b}')" for a in CORR for b in CORR)
case = lambda tag: "case " + tag + " " + " ".join(f"when '{c}' then {c}" for c in CORR) + " end"
EDGES = "[" + ", ".join(f"{k / 10!r}::double" for k in range(1, 10)) + "]"
BINS = ", ".join(f"len(list_filter(q_{c}, lambda z: z < {c})) as b_{c}" for c in [*MI, "lr", "nx"])
MI_SQL = f"""{FT}, x as (select *, log_return as lr, lead(log_return) over {W} as nx, {', '.join(f'{CYC[c]} as {c}' for c in CYCLIC)} from features),
 m as (select symbol, timeframe, {', '.join(MI)}, lr, nx from x where {' and '.join(f'{c} is not null' for c in [*MI, 'nx'])}),
 q as (select symbol, timeframe, {', '.join(f'quantile_cont({c}, {EDGES}) as q_{c}' for c in [*MI, 'lr', 'nx'])} from m group by 1, 2),
 b as (select m.symbol, m.timeframe, {BINS} from m join q using (symbol, timeframe)),
 u as (select symbol, timeframe, unnest({MI!r}) as feature, unnest([{', '.join(f'b_{c}' for c in MI)}]) as fb, b_lr as now, b_nx as nxt from b),
 j1 as (select symbol, timeframe, feature, fb, now as t, count(*)::double as c from u group by all),
 j2 as (select symbol, timeframe, feature, fb, nxt as t, count(*)::double as c from u group by all),
 i1 as (select symbol, timeframe, feature, c, sum(c) over (partition by symbol, timeframe, feature) as n, sum(c) over (partition by symbol, timeframe, feature, fb) as f, sum(c) over (partition by symbol, timeframe, feature, t) as g from j1),
 i2 as (select symbol, timeframe, feature, c, sum(c) over (partition by symbol, timeframe, feature) as n, sum(c) over (partition by symbol, timeframe, feature, fb) as f, sum(c) over (partition by symbol, timeframe, feature, t) as g from j2),
 s1 as (select symbol, timeframe, feature, sum(c / n * ln(c * n / (f * g))) as mi from i1 group by all),
 s2 as (select symbol, timeframe, feature, sum(c / n * ln(c * n / (f * g))) as mi from i2 group by all)
 select s1.symbol, s1.timeframe, feature, round(s1.mi, 6) as mi_current, round(s2.mi, 6) as mi_future from s1 join s2 using (symbol, timeframe, feature)"""

SQL = {
    "price_snapshot": f"""with bars as ({BARS_1D}), a as (select {K2}, arg_max(close, open_time) as last_close, max(high) as max_high, min(low) as min_low, year(max(open_time)) as y from bars group by 1, 2),
      y as (select {K2}, year(open_time) as y, arg_min(close, open_time) as f from bars group by 1, 2, 3)
      select a.symbol, a.timeframe, round(last_close, 6) as last_close, round(max_high, 6) as max_high, round(min_low, 6) as min_low, round((last_close / f - 1) * 100, 6) as ytd_return
      from a join y on a.symbol = y.symbol and a.y = y.y""",
    "kpi_latest": f"""{FT}, l as (select *, lag(close) over {W} as before from features) select {K2}, round(close, 6) as price, round(high, 6) as high, round(low, 6) as low, round(volume, 6) as volume,
      round(rsi_14, 6) as rsi, round(macd_hist, 6) as macd_hist, round((close - before) / (before + 1e-8::double) * 100, 6) as change_pct,
      case when rsi_14 > 70 then 'overbought' when rsi_14 < 30 then 'oversold' else 'neutral' end as rsi_zone, case when macd_hist >= 0 then 'up' else 'down' end as macd_sign
      from l qualify row_number() over (partition by symbol, timeframe order by open_time desc) = 1""",
    "candle_direction": f"with bars as ({BARS_1H}) select {K}, close >= open as is_up, "
    + rsql({"body_bottom": "least(open, close)", "body_height": "greatest(abs(close - open), (high - low) * 0.005::double)", "upper_wick": "high - greatest(open, close)", "lower_wick": "least(open, close) - low"})
    + " from bars",
    "candle_window": f"with bars as ({BARS_1D}) select {K}, {rsql(list(OHLCV))} from bars qualify row_number() over (partition by symbol, timeframe order by open_time desc) <= 180",
    "band_breakouts": f"{FT} select {K}, {rsql(['close', 'bb_upper', 'bb_lower'])}, case when close > bb_upper then 'above' else 'below' end as side from features where close > bb_upper or close < bb_lower",
    "rsi_zones": f"{FT} select {K}, round(greatest(rsi_14 - 70, 0), 6) as overbought, round(greatest(30 - rsi_14, 0), 6) as oversold, case when rsi_14 > 70 then 'overbought' when rsi_14 < 30 then 'oversold' else 'neutral' end as zone from features where rsi_14 is not null",
    "cumulative_return": f"{D} select {K}, round(case when ret is not null then close / first_value(close) over {W} end, 6) as cumulative_return from r",
    "seasonality_dow": f"{D} select {K2}, isodow(open_time) - 1 as day_of_week, round(avg(ret), 6) as mean_return, count(ret) as n, "
    + rsql({"q1": "quantile_cont(ret, 0.25::double)", "median": "quantile_cont(ret, 0.5::double)", "q3": "quantile_cont(ret, 0.75::double)"})
    + " from r where ret is not null group by 1, 2, 3",
    "seasonality_dow_hour": f"{H} select {K2}, isodow(open_time) - 1 as day_of_week, "
    + rsql({f"h{h}": f"coalesce(avg(ret) filter (hour(open_time) = {h}), 0.0)" for h in range(24)})
    + " from r where ret is not null group by 1, 2, 3",
    "seasonality_year_month": f"{D} select {K2}, year(open_time) as year, "
    + rsql({f"m{m}": f"coalesce(avg(ret) filter (month(open_time) = {m}), 0.0)" for m in range(1, 13)})
    + " from r where ret is not null group by 1, 2, 3",
    "anomaly_zscore": f"{FT} select {K}, {rsql(['close', 'price_zscore'])}, case when price_zscore > 0 then 'high' else 'low' end as side from features where abs(price_zscore) > 3",
    "anomaly_counts": f"{FT} select {K2}, count(*) filter (price_zscore > 3) as z_high, count(*) filter (price_zscore < -3) as z_low, count(*) filter (volume_ratio > 3) as volume_spikes from features group by 1, 2",
    "anomaly_volume_spike": f"with bars as ({BARS_SUPP}), m as (select *, volume / nullif({rolled('avg', 'volume', 20)}, 0) as volume_ratio from bars) select {K}, {rsql(['volume', 'volume_ratio'])} from m where volume_ratio > 3",
    "regime_share": f"{FT} select {K2}, regime, count(*) as bars, round(count(*) * 100.0::double / sum(count(*)) over {S}, 6) as pct from features group by 1, 2, 3",
    "vol_regime_share": f"{FT} select {K2}, vol_regime as regime, count(*) as bars, round(count(*) * 100.0::double / sum(count(*)) over {S}, 6) as pct from features group by 1, 2, 3",
    "symbol_correlation": f"{PAIR} select {K}, {rsql({'price_a': 'ca / fa', 'price_b': 'cb / fb', 'rolling_corr': 'rc'})} from c",
    "mean_correlation": f"{PAIR} select {K2}, round(avg(rc), 6) as mean_corr, count(rc) as n from c group by 1, 2",
    "beta_regression": f"""{PAIR}, g as (select {K2}, count(*) as n, regr_slope(rb, ra) as slope, regr_intercept(rb, ra) as intercept, corr(rb, ra) as r from p where ra is not null and rb is not null group by 1, 2)
      select {K2}, n, {rsql({'slope': 'slope', 'intercept': 'intercept', 'r': 'r', 'r2': 'r * r', 't': 'r * sqrt((n - 2) / (1 - r * r))'})} from g""",
    "correlation_matrix": f"""{FT}, k as (select * from features where {' and '.join(f'{c} is not null' for c in CORR)}), p as (select * from (values {PAIRS}) v(feature_a, feature_b)),
      l as (select {K2}, feature_a, feature_b, {case('feature_a')} as a, {case('feature_b')} as b from k cross join p)
      select {K2}, count(*) as n, feature_a, feature_b, round(case when feature_a = feature_b then 1.0 else corr(a, b) end, 6) as corr from l group by {K2}, feature_a, feature_b""",
    "mutual_information": MI_SQL,
    "feature_stability": f"""{FT}, c as (select {K2}, least(90, greatest(20, count(*) // 10)) as w from features group by 1, 2),
      u as (select {K}, unnest({STABLE!r}) as feature, unnest([{', '.join(STABLE)}]) as value from features),
      v as (select u.*, w, row_number() over (partition by symbol, timeframe, feature order by open_time) as rn, avg(value) over (partition by symbol, timeframe, feature) as om from u join c using (symbol, timeframe) where value is not null),
      z as (select a.symbol, a.timeframe, a.feature, a.open_time, any_value(a.w) as w, any_value(a.value) as value, any_value(a.om) as om, any_value(a.rn) as rn, avg(b.value) as m, stddev_samp(b.value) as s
        from v a join v b on a.symbol = b.symbol and a.feature = b.feature and b.rn > a.rn - a.w and b.rn <= a.rn group by 1, 2, 3, 4)
      select {K}, feature, w::bigint as "window", {rsql({'value': 'value', 'rolling_mean': 'case when rn >= w then m end', 'rolling_std': 'case when rn >= w then s end', 'overall_mean': 'om'})} from z""",
}
