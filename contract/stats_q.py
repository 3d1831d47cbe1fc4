"""Statistics queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.common import BARS_1D, BARS_1H, GOOD, S, W, out, rsql
from wickframe.operators import features as f
from wickframe.operators import stats as s
from wickframe.schema import SERIES, TIME
from wickframe.sources.adapters import bars_1d, bars_1h

KEY = [*SERIES, TIME]
K = "symbol, timeframe"
FEATS = ["return_pct", "log_return", "macd", "macd_signal", "macd_hist", "rsi_14", "bb_width", "bb_pct", "atr_14", "volume_ratio", "rolling_vol_30", "price_zscore", "drawdown_pct"]


def rets(spark, sf):
    """Daily order bars with returns and drawdown."""
    return f.returns(bars_1d(spark, sf).filter(GOOD))


def hourly(spark, sf):
    return f.returns(bars_1h(spark, sf).filter(GOOD))


def with_feats(spark, sf):
    return f.with_indicators(bars_1h(spark, sf).filter(GOOD), f.train_indicators())


QUERIES = {
    "return_stats": lambda x, d: out(s.return_stats(rets(x, d))),
    "value_at_risk": lambda x, d: out(s.value_at_risk(rets(x, d))),
    "max_drawdown": lambda x, d: out(s.max_drawdown(f.drawdown(bars_1d(x, d)))),
    "worst_drawdowns": lambda x, d: out(s.worst_drawdowns(f.drawdown(bars_1d(x, d)))),
    "jarque_bera": lambda x, d: out(s.jarque_bera(rets(x, d))),
    "ljung_box": lambda x, d: out(s.ljung_box(rets(x, d))),
    "kpss_test": lambda x, d: out(s.kpss_test(hourly(x, d), "close")),
    "hurst_rs": lambda x, d: out(s.hurst_rs(hourly(x, d))),
    "hurst_rs_dashboard": lambda x, d: out(s.hurst_rs(hourly(x, d), variant="dashboard")),
    "adf_test": lambda x, d: out(s.adf_test(rets(x, d), "log_return")),
    "adf_by_feature": lambda x, d: out(s.adf_by_feature(with_feats(x, d), FEATS)),
    "diagnostics_report": lambda x, d: out(s.diagnostics_report(rets(x, d))),
    "return_histogram": lambda x, d: out(s.return_histogram(rets(x, d))),
    "normal_overlay": lambda x, d: out(s.normal_overlay(rets(x, d))),
    "kde_grid": lambda x, d: out(s.kde_grid(rets(x, d))),
    "qq_points": lambda x, d: out(s.qq_points(rets(x, d))),
    "feature_distribution": lambda x, d: out(s.feature_distribution(with_feats(x, d), FEATS)),
}

D = f"with recursive bars as ({BARS_1D}), r as (select * from (select *, ln(close / lag(close) over {W}) as x from bars where {GOOD}) where x is not null)"
H = f"with bars as ({BARS_1H}), h as (select symbol, timeframe, close as x, row_number() over {W} - 1 as rn, count(*) over {S} as n from bars where {GOOD})"
DD = f"with bars as ({BARS_1D}), d as (select *, (close / max(close) over {W} - 1) * 100 as dd from bars)"


def hurst_sql(sample: bool) -> str:
    std = "stddev_samp(x)" if sample else "stddev_pop(x)"
    rs = "case when sd > 0 then (hi - lo) / sd end" if sample else "(hi - lo) / (sd + 1e-10::double)"
    h = "greatest(0.0, least(1.0, regr_slope(ln(rs), ln(lag))))" if sample else "regr_slope(ln(rs), ln(lag))"
    return f"""{H}, l as (select unnest(range(2, 100)) as lag),
      c as (select symbol, timeframe, rn, lag, rn // lag as c, x, x - avg(x) over (partition by symbol, timeframe, lag, rn // lag) as e
            from h join l on lag < least(100, n // 2) and (rn // lag + 1) * lag < n),
      k as (select *, sum(e) over (partition by symbol, timeframe, lag, c order by rn) as s from c),
      q as (select symbol, timeframe, lag, c, max(s) as hi, min(s) as lo, {std} as sd from k group by 1, 2, 3, 4),
      m as (select symbol, timeframe, lag, avg({rs}) as rs from q group by 1, 2, 3),
      z as (select symbol, timeframe, {h} as hurst from m group by 1, 2)
      select symbol, timeframe, round(hurst, 6) as hurst, case when hurst > 0.55 then 'trending' when hurst < 0.45 then 'mean-reverting' else 'random walk' end as interpretation from z"""


SQL = {
    "return_stats": f"{D} select {K}, count(*) as n, {rsql({'mean': 'avg(x)', 'std': 'stddev_samp(x)', 'skewness': 'skewness(x)', 'kurtosis': 'kurtosis(x)', 'min': 'min(x)', 'max': 'max(x)'})} from r group by 1, 2",
    "value_at_risk": f"{D}, v as (select {K}, quantile_cont(x, 0.05::double) as v from r group by 1, 2) select r.symbol, r.timeframe, round(any_value(v), 6) as var, round(avg(x) filter (x <= v), 6) as cvar from r join v using (symbol, timeframe) group by 1, 2",
    "max_drawdown": f"{DD} select {K}, round(dd, 6) as max_drawdown, open_time as at, round(close, 6) as close_at from d qualify row_number() over (partition by symbol, timeframe order by dd, open_time) = 1",
    "worst_drawdowns": f"{DD} select {K}, open_time, round(dd, 6) as drawdown_pct, row_number() over (partition by symbol, timeframe order by dd, open_time) as rank from d qualify rank <= 5",
    "jarque_bera": f"""{D}, m as (select {K}, avg(x) as m from r group by 1, 2), c as (select r.symbol, r.timeframe, count(*)::double as n, avg((x - m) ** 2) as m2, avg((x - m) ** 3) as m3, avg((x - m) ** 4) as m4 from r join m using (symbol, timeframe) group by 1, 2),
      j as (select {K}, n / 6 * ((m3 / m2 ** 1.5) ** 2 + (m4 / m2 ** 2 - 3) ** 2 / 4) as q from c) select {K}, round(q, 6) as statistic, round(exp(-q / 2), 6) as p_value, exp(-q / 2) > 0.05 as is_normal from j""",
    "ljung_box": f"""{D}, e as (select *, x - avg(x) over {S} as e, row_number() over {W} as rn, count(*) over {S} as n from r), l as (select unnest(range(1, 11)) as k),
      g as (select a.symbol, a.timeframe, k, any_value(a.n) as n, sum(a.e * b.e) as g from e a join l on true join e b on a.symbol = b.symbol and b.rn = a.rn - k group by 1, 2, 3),
      v as (select {K}, sum(e * e) as v from e group by 1, 2),
      q as (select {K}, any_value(n) * (any_value(n) + 2) * sum((g / v) ** 2 / (n - k)) as q from g join v using (symbol, timeframe) group by 1, 2)
      select {K}, 10::bigint as lags, round(q, 6) as statistic, round(p, 6) as p_value, p < 0.05 as has_autocorr from
      (select *, exp(-q / 2) * (1 + q / 2 + (q / 2) ** 2 / 2 + (q / 2) ** 3 / 6 + (q / 2) ** 4 / 24) as p from q)""",
    "kpss_test": f"""{H}, e as (select *, x - avg(x) over {S} as e from h), c as (select *, sum(e) over (partition by symbol, timeframe order by rn) as cs from e),
      l as (select unnest(range(0, 400)) as k), g as (select a.symbol, a.timeframe, k, any_value(a.n) as n, sum(a.e * b.e) as g from e a join l on true join e b on a.symbol = b.symbol and b.rn = a.rn - k group by 1, 2, 3),
      b as (select {K}, any_value(n) as n, sum(case when k = 0 then g else 2 * g end) as s0, sum(2 * k * g) as s1 from g where k <= floor(pow(n, 2.0::double / 9)) group by 1, 2),
      w as (select {K}, n, least(floor(1.1447::double * pow(pow(s1 / s0, 2), 1.0::double / 3) * pow(n, 1.0::double / 3)), n - 1)::bigint as nlags from b),
      v as (select {K}, sum(case when k = 0 then g else 2 * (1 - k / (nlags + 1.0::double)) * g end) as v from g join w using (symbol, timeframe) where k <= nlags group by 1, 2),
      t as (select {K}, sum(cs * cs) as t from c group by 1, 2), z as (select {K}, nlags, t / (n * v) as s from w join v using (symbol, timeframe) join t using (symbol, timeframe)),
      p as (select *, case when s < 0.347 then 0.1 when s < 0.463 then 0.1 + (s - 0.347::double) * -0.05::double / 0.116::double when s < 0.574 then 0.05 + (s - 0.463::double) * -0.025::double / 0.111::double
        when s < 0.739 then 0.025 + (s - 0.574::double) * -0.015::double / 0.165::double else 0.01 end as p from z)
      select {K}, nlags, round(s, 6) as statistic, round(p, 6) as p_value, p > 0.05 as is_stationary from p""",
    "hurst_rs": hurst_sql(False),
    "hurst_rs_dashboard": hurst_sql(True),
    "return_histogram": f"""{D}, b as (select *, min(x) over {S} as lo, max(x) over {S} as hi, count(*) over {S} as n from r)
      select {K}, least(floor((x - lo) / ((hi - lo) / 80)), 79)::bigint as bin, count(*) as count, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 80, 6) as "left",
      round(count(*) / (any_value(n) * (any_value(hi) - any_value(lo)) / 80), 6) as density from b group by 1, 2, 3""",
    "normal_overlay": f"""{D}, a as (select {K}, avg(x) as m, stddev_samp(x) as s, min(x) as lo, max(x) as hi from r group by 1, 2), g as (select *, unnest(range(0, 200)) as i from a)
      select {K}, i, round(lo + i * (hi - lo) / 199, 6) as x, round(exp(-1 * (((lo + i * (hi - lo) / 199 - m) / s) ** 2) / 2) / (s * sqrt(2 * pi())), 6) as pdf from g""",
    "kde_grid": f"""{D}, a as (select {K}, stddev_samp(x) * pow(count(*), -0.2::double) as h, count(*) as n, min(x) as lo, max(x) as hi from r group by 1, 2), g as (select *, unnest(range(0, 200)) as i from a),
      k as (select *, lo + i * (hi - lo) / 199 as gx from g)
      select k.symbol, k.timeframe, i, round(any_value(gx), 6) as x, round(sum(exp(-1 * (((gx - r.x) / h) ** 2) / 2) / (n * h * sqrt(2 * pi()))), 6) as density from k join r using (symbol, timeframe) group by 1, 2, 3""",
}

from contract.features_q import BASE, features_cte  # noqa: E402

SQL["feature_distribution"] = (
    f"with recursive {BASE}, good as (select * from bars where {GOOD}), {features_cte('good')}, u as (select {K}, unnest({FEATS!r}) as feature, "
    f"unnest([{', '.join(FEATS)}]) as value from features) select symbol, timeframe, feature, count(value) as n, "
    + rsql({"mean": "avg(value)", "std": "stddev_samp(value)", "skewness": "skewness(value)", "kurtosis": "kurtosis(value)"})
    + " from u where value is not null group by 1, 2, 3"
)
