"""Blocked series operators against pandas, with blocks far smaller than the series."""

import math

import numpy as np
import pandas as pd
import pytest
from conftest import candle_rows
from pyspark.sql import functions as F

from wickframe.operators import features as f
from wickframe.operators import stats as st
from wickframe.operators import supervised as sv
from wickframe.operators.blocks import Layout, Running, index_series
from wickframe.operators.quantiles import exact_quantiles, from_order_bits, order_bits
from wickframe.operators.scans import Ewm

SMALL = Layout(span=100, rows=1024)


@pytest.fixture(scope="module")
def candles(spark):
    a = candle_rows(5000, "A", "1h", seed=3, flat=True)
    a = a.drop(index=[10, 11, 700, 2048, 2049, 2050]).reset_index(drop=True)
    b = candle_rows(300, "B", "1h", seed=4)
    pdf = pd.concat([a, b])
    return pdf, spark.createDataFrame(pdf.sample(frac=1, random_state=0))


def weighted(values, share):
    """Each value moves the mean by ``share`` of its distance; the first value starts it."""
    mean, out = values[0], []
    for v in values:
        mean = (1 - share) * mean + share * v
        out.append(mean)
    return out


def trailing(values, n, fn):
    """``fn`` of the last n values, nan while there are fewer or one is nan."""
    return [fn(values[i + 1 - n : i + 1]) if i + 1 >= n else math.nan for i in range(len(values))]


def spread(values):
    middle = math.fsum(values) / len(values)
    return math.sqrt(math.fsum((v - middle) ** 2 for v in values) / (len(values) - 1))


def average(values):
    return math.fsum(values) / len(values)


def by_definition(g):
    """Indicators as plain recurrences over lists."""
    high, low, close = (g[c].tolist() for c in ("high", "low", "close"))
    moves = [0.0] + [b - a for a, b in zip(close, close[1:])]
    ups, downs = weighted([max(m, 0.0) for m in moves], 1 / 14), weighted([max(-m, 0.0) for m in moves], 1 / 14)
    ranges = [high[0] - low[0]] + [max(h, c) - min(x, c) for h, x, c in zip(high[1:], low[1:], close)]
    macd = [a - b for a, b in zip(weighted(close, 2 / 13), weighted(close, 2 / 27))]
    middle = trailing(close, 20, average)
    logs = [math.nan] + [math.log(b / a) for a, b in zip(close, close[1:])]
    tops, drops = -math.inf, []
    for c in close:
        tops = max(tops, c)
        drops.append((c / tops - 1) * 100)
    return {
        "ma_99": trailing(close, 99, average),
        "bb_mid": middle,
        "bb_upper": [m + 2 * s for m, s in zip(middle, trailing(close, 20, spread))],
        "macd": macd,
        "macd_signal": weighted(macd, 0.2),
        "rsi_14": [100 * u / (u + d) if d > 0 else math.nan for u, d in zip(ups, downs)],
        "atr_14": weighted(ranges, 1 / 14),
        "rolling_vol_30": [s * math.sqrt(8760) for s in trailing(logs, 30, spread)],
        "drawdown_pct": drops,
    }


def test_features_across_blocks(candles):
    pdf, df = candles
    got = f.engineer_features(df, False, SMALL).toPandas()
    for sym, g in pdf.groupby("symbol"):
        want = pd.DataFrame(by_definition(g))
        have = got[got["symbol"] == sym].sort_values("open_time").reset_index(drop=True)
        assert len(have) == len(want)
        for c in want.columns:
            np.testing.assert_allclose(have[c], want[c].to_numpy(), rtol=1e-9, atol=1e-8, err_msg=c)
        q33, q66 = want["atr_14"].quantile(0.33), want["atr_14"].quantile(0.66)
        label = np.where(want["atr_14"] >= q66, "High", np.where(want["atr_14"] <= q33, "Low", "Mid"))
        assert (have["vol_regime"].to_numpy() == label).all()
        rsi = have["rsi_14"].dropna()
        assert ((rsi >= 0) & (rsi <= 100)).all()
    np.testing.assert_allclose(got["hour_sin"] ** 2 + got["hour_cos"] ** 2, 1, atol=1e-9)


def test_quiet_run_keeps_its_ratio(spark):
    """Means of gains and losses fade together, so the strength stays defined over a long flat stretch."""
    g = candle_rows(6000, "Q", "1m", seed=9)
    for c in ("open", "high", "low", "close"):
        g.loc[40:, c] = g.loc[40, c]
    got = f.engineer_features(spark.createDataFrame(g), False).toPandas().sort_values("open_time")
    want = pd.DataFrame(by_definition(g))
    for c in ("rsi_14", "macd", "macd_signal", "atr_14"):
        np.testing.assert_allclose(got[c], want[c], rtol=1e-7, atol=1e-12, err_msg=c)
    assert got["rsi_14"].isna().sum() < 20


def test_weighted_mean_passes_over_nulls(spark):
    """A null close was refused before; now the mean goes on as in pandas."""
    g = candle_rows(60, "N", "1d", seed=2)
    g.loc[20, "close"] = None
    got = f.ema(spark.createDataFrame(g)).toPandas().sort_values("open_time")
    for span in (12, 26):
        np.testing.assert_allclose(got[f"ema_{span}"], g["close"].ewm(span=span, adjust=False).mean(), rtol=1e-12)



def test_series_together_equal_series_alone(candles):
    _, df = candles
    both = f.macd(df, SMALL).filter("symbol = 'B'").select("open_time", "macd_signal")
    alone = f.macd(df.filter("symbol = 'B'")).select("open_time", "macd_signal")
    a, b = both.toPandas().sort_values("open_time"), alone.toPandas().sort_values("open_time")
    np.testing.assert_allclose(a["macd_signal"], b["macd_signal"], rtol=1e-12)


def test_running_aggregates(candles):
    pdf, df = candles
    run = {
        "top": Running("max", F.col("close")),
        "low_": Running("min", F.col("close")),
        "cum": Running("sum", F.col("close")),
        "first_": Running("first", F.col("close")),
        "prev": Running("prev", F.col("close")),
        "fill": Running("ffill", F.when(F.pmod(F.hour("open_time"), F.lit(7)) == 0, F.col("close"))),
    }
    got = index_series(df, run, layout=SMALL).filter("symbol = 'A'").toPandas().sort_values("open_time").reset_index(drop=True)
    c = pdf[pdf["symbol"] == "A"]["close"].reset_index(drop=True)
    t = pdf[pdf["symbol"] == "A"]["open_time"].reset_index(drop=True)
    assert (got["_rn"] == np.arange(len(c))).all() and (got["_total"] == len(c)).all()
    want = {"top": c.cummax(), "low_": c.cummin(), "cum": c.cumsum(), "first_": c * 0 + c[0], "prev": c.shift(), "fill": c.where(t.dt.hour % 7 == 0).ffill()}
    for k, v in want.items():
        np.testing.assert_allclose(got[k], v, rtol=1e-12, err_msg=k)


def test_lead_across_blocks(candles):
    pdf, df = candles
    got = sv.make_supervised(df, horizon=5, layout=SMALL).filter("symbol = 'A'").toPandas().sort_values("open_time")
    c = pdf[pdf["symbol"] == "A"]["close"]
    np.testing.assert_allclose(got["y"], c.shift(-5).dropna())


def test_quantiles_of_large_groups(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([np.exp(rng.normal(0, 3, 30_000)), np.full(15_000, 2.5), rng.integers(0, 5, 5_000)])
    sizes = {"b": 999, "c": 1, "d": 9_999, "e": 10_001, None: 40}
    small = [rng.normal(size=n) for n in sizes.values()]
    keys = ["a"] * len(x) + [k for k, n in sizes.items() for _ in range(n)]
    pdf = pd.DataFrame({"k": pd.Series(keys, dtype=object), "x": np.concatenate([x, *small])})
    probs = {"lo": 0.001, "q33": 0.33, "mid": 0.5, "q66": 0.66, "hi": 0.999, "max_": 1.0}
    df = spark.createDataFrame(pdf, "k string, x double")
    got = exact_quantiles(df, ["k"], "x", probs).collect()
    assert len(got) == 6
    for r in got:
        v = pdf[pdf["k"].isna() if r.k is None else pdf["k"] == r.k]["x"]
        assert r.n == len(v)
        np.testing.assert_allclose([r[p] for p in probs], [v.quantile(q) for q in probs.values()], rtol=1e-12)


def test_order_bits(spark):
    rng = np.random.default_rng(4)
    edge = [0.0, -0.0, 5e-324, 1e-310, 2.0**-1022, 1.0, 1 - 2**-53, 2.0, 1.7976931348623157e308, np.inf]
    powers = [2.0**e for e in range(-1074, 1024, 37)]
    near = [np.nextafter(p, d) for p in powers for d in (0, np.inf)]
    x = np.concatenate([edge, powers, near, np.exp(rng.normal(0, 90, 4000)), rng.normal(size=2000)])
    x = np.concatenate([x, -x])
    df = spark.createDataFrame(pd.DataFrame({"x": x})).select("x", order_bits(F.col("x")).alias("k"))
    got = df.select("x", "k", from_order_bits(F.col("k")).alias("y")).toPandas()
    assert (got["x"] == got["y"]).all()
    bits = got["x"].abs().to_numpy().view("i8")
    assert (got["k"].abs() == bits).all() and ((got["k"] < 0) == (got["x"] < 0)).all()
    odd = spark.sql("select double('NaN') as x union all select null").select(order_bits(F.col("x")).alias("k")).collect()
    assert {r.k for r in odd} == {None, 2047 * 2**52 + 1}


def test_quantiles_in_three_rounds(spark, monkeypatch):
    from wickframe.operators import quantiles

    monkeypatch.setattr(quantiles, "BIN_VALUES", 10)
    rng = np.random.default_rng(7)
    x = np.concatenate([1 + rng.random(5000) * 1e-9, rng.normal(size=3000)])
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(8000) % 2, "x": x}))
    probs = {"a": 0.1, "b": 0.5, "c": 0.77}
    for r in exact_quantiles(df, ["k"], "x", probs).collect():
        np.testing.assert_allclose([r.a, r.b, r.c], np.quantile(x[r.k :: 2], list(probs.values())), rtol=1e-15)


def test_quantiles_read_little(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": [1, 1, 2], "x": [1.0, 2.0, -3.5]}))
    got = exact_quantiles(df, ["k"], "x", {"a": 0.5, "b": 0.9})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # the values and the bins of the round before
    assert plan.count("Exchange hashpartitioning") <= 3
    assert {(r.k, r.n, r.a, round(r.b, 9)) for r in got.collect()} == {(1, 2, 1.5, 1.9), (2, 1, -3.5, -3.5)}


def test_quantiles_by_series_size(spark):
    pdf = pd.concat([candle_rows(12_000, "L", "1m", seed=5), candle_rows(50, "S", "1m", seed=6)])
    df = spark.createDataFrame(pdf)
    got = exact_quantiles(df, f.SERIES, "close", {"m": 0.33}).toPandas()
    for _, r in got.iterrows():
        assert r["m"] == pytest.approx(pdf[pdf["symbol"] == r["symbol"]]["close"].quantile(0.33), rel=1e-12)


@pytest.mark.parametrize("span", [1, 1.5, 3, 14, 200])
def test_weighted_means_with_nulls(spark, span):
    """As pandas: a null keeps the mean and lets it decay; blocks, long gaps and empty blocks included."""
    rng = np.random.default_rng(int(span * 10))
    frames = []
    for symbol, n, share in (("A", 4000, 0.3), ("B", 3000, 0.95), ("C", 700, 0.0), ("D", 2500, 1.0), ("E", 5, 0.4)):
        pdf = candle_rows(n, symbol, "1m", seed=3)
        hidden = rng.random(n) < share
        hidden[: n // 5] |= symbol == "B"
        if symbol == "A":
            hidden[500:2200] = True
        pdf["x"] = pdf["close"].mask(hidden)
        frames.append(pdf)
    pdf = pd.concat(frames)
    df = spark.createDataFrame(pdf.assign(x=pdf["x"].astype(object).where(pdf["x"].notna(), None)), "symbol string, timeframe string, open_time timestamp, open double, high double, low double, close double, volume double, x double")
    spec = f.Indicator(("y", "z"), {2: {"y": Ewm.span("x", span)}, 3: {"d": F.col("y") - 1}, 4: {"z": Ewm.span("d", 5)}})
    got = f.with_indicators(df, [spec], SMALL).toPandas().sort_values("open_time")
    for symbol, part in pdf.groupby("symbol"):
        g = got[got["symbol"] == symbol].reset_index(drop=True)
        y = part["x"].reset_index(drop=True).ewm(span=span, adjust=False).mean()
        z = (y - 1).ewm(span=5, adjust=False).mean()
        np.testing.assert_allclose(g["y"], y, rtol=1e-11)
        np.testing.assert_allclose(g["z"], z, rtol=1e-11)


def test_weighted_means_stay_in_their_series(spark):
    pdf = pd.concat([candle_rows(30, "A").assign(x=np.inf), candle_rows(30, "B").assign(x=2.0)])
    got = f.with_indicators(spark.createDataFrame(pdf), [f.Indicator(("y",), {1: {"y": Ewm.span("x", 3)}})]).toPandas()
    assert (got[got["symbol"] == "B"]["y"] == 2.0).all()
    for alpha in (0.0, -1.0, 1.1):
        with pytest.raises(ValueError):
            Ewm("x", alpha)


def test_long_span_mean(spark):
    pdf = candle_rows(4000, "A", "1m", seed=8)
    got = f.ema(spark.createDataFrame(pdf), SMALL, spans=(2, 200)).toPandas().sort_values("open_time")
    for s in (2, 200):
        np.testing.assert_allclose(got[f"ema_{s}"], pdf["close"].ewm(span=s, adjust=False).mean(), rtol=1e-10)


def adf_brute(y):
    n = len(y)
    dy = np.diff(y)
    p = st.adf_max_lag(n)

    def fit(lags, start):
        t = np.arange(start, n)
        x = np.column_stack([y[t - 1], np.ones(len(t))] + [dy[t - 1 - j] for j in range(1, lags + 1)])
        beta, *_ = np.linalg.lstsq(x, dy[t - 1], rcond=None)
        res = dy[t - 1] - x @ beta
        ssr = res @ res
        se = np.sqrt(ssr / (len(t) - x.shape[1]) * np.linalg.inv(x.T @ x)[0, 0])
        aic = len(t) * (np.log(2 * np.pi * ssr / len(t)) + 1) + 2 * x.shape[1]
        return beta[0] / se, aic

    best = min(range(p + 1), key=lambda k: fit(k, p + 1)[1])
    return best, fit(best, best + 1)[0]


def test_adf(candles):
    pdf, df = candles
    for r in st.adf_test(df, "close", SMALL).collect():
        lags, stat = adf_brute(pdf[pdf["symbol"] == r.symbol]["close"].to_numpy())
        assert r.lags == lags and r.statistic == pytest.approx(stat, rel=1e-6)
    assert st.adf_p_value(-2.86) == pytest.approx(0.05, abs=0.002) and st.adf_p_value(-3.43) == pytest.approx(0.01, abs=0.001)


def test_statistics_do_not_depend_on_blocks(candles):
    _, df = candles
    r = f.returns(df)
    for op in (lambda x, lay: st.kpss_test(x, "close", lay), lambda x, lay: st.hurst_rs(x, layout=lay), lambda x, lay: st.ljung_box(x, layout=lay)):
        a, b = (op(r, lay).toPandas().sort_values("symbol").reset_index(drop=True) for lay in (SMALL, Layout()))
        pd.testing.assert_frame_equal(a, b, rtol=1e-8)


def test_chi_square_tail(spark):
    from wickframe.functions.special import chi2_tail_even, t_two_sided

    assert spark.range(1).select(chi2_tail_even(F.lit(6.2876), 10)).first()[0] == pytest.approx(0.7905, abs=1e-4)
    assert t_two_sided(2.228, 10) == pytest.approx(0.05, abs=1e-4)


def test_ranks_with_ties(spark):
    pdf = candle_rows(4000, "A", "1m", seed=9).assign(x=lambda d: np.where(np.arange(len(d)) % 3 == 0, 1.0, d["close"]))
    df = spark.createDataFrame(pdf[["symbol", "timeframe", "open_time", "x"]])
    got = st.rank_values(df, SMALL).toPandas().sort_values("rank")
    want = pdf.sort_values(["x", "open_time"])
    assert (got["rank"].to_numpy() == np.arange(1, 4001)).all()
    assert (got["open_time"].to_numpy() == want["open_time"].to_numpy()).all()


def test_identity_gives_infinite_vif(spark):
    from wickframe.operators.eda import vif

    rng = np.random.default_rng(1)
    a, b, c = rng.normal(size=(3, 200))
    pdf = pd.DataFrame({"symbol": "A", "timeframe": "1d", "a": a, "b": b, "s": a - b, "c": c + 0.5 * a})
    got = vif(spark.createDataFrame(pdf), ["a", "b", "s", "c"]).toPandas().set_index("feature")["vif"]
    assert np.isinf(got[["a", "b", "s"]]).all() and np.isfinite(got["c"])
    got = vif(spark.createDataFrame(pdf), ["a", "b", "c"]).toPandas().set_index("feature")["vif"]
    want = np.diag(np.linalg.inv(np.corrcoef(np.array([a, b, pdf["c"]]))))
    np.testing.assert_allclose(got[["a", "b", "c"]], want, rtol=1e-9)
