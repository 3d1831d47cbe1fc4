"""Descriptive statistics and tests: one row per series.

Sums run as ordinary aggregates. Lagged products and chunk ranges run on row blocks, where a task
sees one block and its halo; the partial results are then summed per series.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickframe.functions.special import chi2_tail_even, normal_cdf, sample_kurtosis, sample_skew
from wickframe.operators.blocks import DEFAULT, Layout, Running, drop_index, index_series, row_blocks, top_per_series
from wickframe.operators.quantiles import exact_quantiles
from wickframe.plans.lineage import cut
from wickframe.plans.lineage import written
from wickframe.schema import SERIES, TIME

KEYS = list(SERIES)
KEY_SCHEMA = "symbol string, timeframe string"


def _present(df: DataFrame, column: str, extra=()) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).select(*KEYS, TIME, F.col(column).cast("double").alias("x"), *extra)


def return_stats(df: DataFrame, column: str = "log_return") -> DataFrame:
    """Mean, deviation, bias-corrected skewness and excess kurtosis, extremes."""
    x, n = F.col(column), F.col("n")
    out = df.filter(x.isNotNull()).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.skewness(x).alias("skewness"),
        F.kurtosis(x).alias("kurtosis"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )
    return out.withColumns(
        {"skewness": sample_skew(n, F.col("skewness")), "kurtosis": sample_kurtosis(n, F.col("kurtosis"))}
    )


def value_at_risk(df: DataFrame, column: str = "log_return", level: float = 0.05) -> DataFrame:
    """Linear quantile of the returns and the mean of the returns at or below it. The returns are written once."""
    x = written(df.select(*KEYS, F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull()))
    var = exact_quantiles(x, KEYS, "x", {"var": level}, stored=True).drop("n")
    below = F.avg(F.when(F.col("x") <= F.col("var"), F.col("x"))).alias("cvar")
    return x.join(var, KEYS).groupBy(*KEYS).agg(F.first("var").alias("var"), below)


def max_drawdown(df: DataFrame) -> DataFrame:
    """Deepest drawdown of every series and the candle where it occurs (the first on ties)."""
    order = F.struct(F.col("drawdown_pct"), F.col(TIME))
    return df.filter(F.col("drawdown_pct").isNotNull()).groupBy(*KEYS).agg(
        F.min("drawdown_pct").alias("max_drawdown"), F.min_by(TIME, order).alias("at"), F.min_by("close", order).alias("close_at")
    )


def worst_drawdowns(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` deepest bars of every series, with their rank."""
    rows = df.filter(F.col("drawdown_pct").isNotNull()).select(*KEYS, TIME, "drawdown_pct")
    return top_per_series(rows, n, [F.col("drawdown_pct"), F.col(TIME)]).withColumnRenamed("_r", "rank")


def jarque_bera(df: DataFrame, column: str = "log_return") -> DataFrame:
    n, s, k = F.col("n"), F.col("_s"), F.col("_k")
    agg = df.filter(F.col(column).isNotNull()).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.skewness(column).alias("_s"), F.kurtosis(column).alias("_k")
    )
    return (
        agg.withColumn("statistic", n / 6 * (s * s + k * k / 4))
        .withColumn("p_value", F.exp(-F.col("statistic") / 2))
        .withColumn("is_normal", F.col("p_value") > 0.05)
        .select(*KEYS, "statistic", "p_value", "is_normal")
    )


def _centred(df: DataFrame, column: str, layout: Layout) -> DataFrame:
    """Indexed non-null values with the mean of their series as attribute."""
    x = _present(df, column)
    mean = x.groupBy(*KEYS).agg(F.avg("x").alias("mean"))
    return index_series(x, layout=layout, attributes=mean).withColumn("e", F.col("x") - F.col("mean"))


def ljung_box(df: DataFrame, column: str = "log_return", lags: int = 10, layout: Layout = DEFAULT) -> DataFrame:
    """Ljung-Box statistic over ``lags`` (even) autocorrelations and its chi-square tail."""
    w = Window.partitionBy(*KEYS, "_blk").orderBy("_rn")
    b = row_blocks(_centred(df, column, layout), lags, layout)
    b = b.withColumns({f"_p{k}": F.col("e") * F.lag("e", k).over(w) for k in range(1, lags + 1)}).filter("_own")
    agg = b.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("e") * F.col("e")).alias("_v"),
        *[F.sum(f"_p{k}").alias(f"_g{k}") for k in range(1, lags + 1)],
    )
    n, q = F.col("n"), F.lit(0.0)
    for k in range(1, lags + 1):
        r = F.try_divide(F.col(f"_g{k}"), F.col("_v"))
        q = q + r * r / (n - k)
    out = agg.filter(n > lags).withColumn("statistic", n * (n + 2) * q)
    out = out.withColumn("p_value", chi2_tail_even(F.col("statistic"), lags))
    return out.select(*KEYS, F.lit(lags).cast("bigint").alias("lags"), "statistic", "p_value", (F.col("p_value") < 0.05).alias("has_autocorr"))


# Critical values of the level KPSS statistic and their p-values.
KPSS_STAT = (0.347, 0.463, 0.574, 0.739)
KPSS_P = (0.10, 0.05, 0.025, 0.01)


def _lag_products(x: DataFrame, attributes: DataFrame, layout: Layout) -> DataFrame:
    """Sums of ``e_t * e_(t-i)`` per series for i = 0.._lags, computed block by block.

    ``attributes`` holds the mean and ``_lags`` of every series; its largest value is the halo.
    """
    most = attributes.agg(F.max("_lags")).first()[0] or 0
    indexed = index_series(x, layout=layout, attributes=attributes).withColumn("e", F.col("x") - F.col("mean"))
    rows = row_blocks(indexed, int(most), layout)

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rn")
        e, own, rn = pdf["e"].to_numpy(), pdf["_own"].to_numpy(), pdf["_rn"].to_numpy()
        top = int(pdf["_lags"].iloc[0])
        mine = np.where(own, e, 0.0)
        sums = [float(mine @ e)] + [float(mine[i:] @ e[:-i]) if i < len(e) else 0.0 for i in range(1, top + 1)]
        assert (np.diff(rn) == 1).all()
        return pd.DataFrame(
            {"symbol": pdf["symbol"].iloc[0], "timeframe": pdf["timeframe"].iloc[0], "lag": range(top + 1), "s": sums}
        )

    parts = rows.select(*KEYS, "_blk", "_rn", "_own", "e", "_lags").groupBy(*KEYS, "_blk")
    out = parts.applyInPandas(products, f"{KEY_SCHEMA}, lag bigint, s double")
    return out.groupBy(*KEYS, "lag").agg(F.sum("s").alias("s"))


def kpss_test(df: DataFrame, column: str = "log_return", layout: Layout = DEFAULT) -> DataFrame:
    """Level KPSS with automatic bandwidth. The p-value is interpolated and clipped to [0.01, 0.10]."""
    x = _present(df, column)
    size = x.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"))
    n = F.col("n").cast("double")
    size = cut(size.withColumn("_lags", F.floor(F.pow(n, 2.0 / 9.0))))
    i, s = F.col("lag"), F.col("s")
    short = _lag_products(x, size.drop("n"), layout).groupBy(*KEYS).agg(
        F.sum(F.when(i == 0, s).otherwise(2 * s)).alias("_s0"), F.sum(2 * i * s).alias("_s1")
    )
    ratio = F.try_divide(F.col("_s1"), F.col("_s0"))
    width = 1.1447 * F.pow(ratio * ratio, 1.0 / 3.0) * F.pow(n, 1.0 / 3.0)
    size = cut(
        size.drop("_lags").join(short, KEYS).select(*KEYS, "n", "mean", F.least(F.floor(width), F.col("n") - 1).alias("_lags"))
    )
    cum = index_series(x, {"_cum": Running("sum", F.col("x"))}, layout=layout, attributes=size.select(*KEYS, "mean"))
    eta = cum.groupBy(*KEYS).agg(F.sum(F.pow(F.col("_cum") - (F.col("_rn") + 1) * F.col("mean"), 2)).alias("_eta"))
    weight = F.when(i == 0, F.lit(1.0)).otherwise(2 * (1 - i / (F.col("_lags") + 1)))
    long = _lag_products(x, size.drop("n"), layout)
    var = long.join(size.select(*KEYS, "_lags"), KEYS).groupBy(*KEYS).agg(F.sum(weight * s).alias("_var"))
    out = size.withColumnRenamed("_lags", "nlags").join(eta, KEYS).join(var, KEYS)
    out = out.withColumn("statistic", F.try_divide(F.col("_eta"), F.col("n") * F.col("_var")))
    st, p = F.col("statistic"), None
    for k in range(3):
        a, b, pa, pb = KPSS_STAT[k], KPSS_STAT[k + 1], KPSS_P[k], KPSS_P[k + 1]
        line = pa + (st - a) * (pb - pa) / (b - a)
        p = F.when((st >= a) & (st < b), line) if p is None else p.when((st >= a) & (st < b), line)
    p = p.when(st < KPSS_STAT[0], F.lit(KPSS_P[0])).otherwise(F.lit(KPSS_P[-1]))
    return out.withColumn("p_value", p).select(
        *KEYS, "nlags", "statistic", "p_value", (F.col("p_value") > 0.05).alias("is_stationary")
    )


def hurst_rs(df: DataFrame, column: str = "close", max_lag: int = 100, variant: str = "eda", layout: Layout = DEFAULT) -> DataFrame:
    """Hurst exponent by rescaled ranges over chunks of 2 .. min(max_lag, n / 2) - 1 rows.

    ``eda``: population deviation + 1e-10. ``dashboard``: sample deviation, chunks without
    deviation skipped, at least 5 lags, clipped to [0, 1]. The last chunk is left out when it ends
    with the series. A chunk belongs to the block of its last row; the halo holds its start.
    """
    if variant not in ("eda", "dashboard"):
        raise ValueError(f"unknown variant {variant}")
    sample = variant == "dashboard"
    rows = row_blocks(index_series(_present(df, column), layout=layout), max_lag, layout)

    def ranges(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rn")
        x, own, rn = pdf["x"].to_numpy(), pdf["_own"].to_numpy(), pdf["_rn"].to_numpy()
        n = int(pdf["_total"].iloc[0])
        first, lo, hi = int(rn[0]), int(rn[own][0]), int(rn[own][-1])
        lags, sums, counts = [], [], []
        for lag in range(2, min(max_lag, n // 2)):
            c0 = -(-(lo + 1) // lag) - 1  # first chunk whose last row lies in the block
            c1 = min((hi + 1) // lag - 1, (n - 1) // lag - 1)
            if c1 < c0:
                continue
            part = x[c0 * lag - first : (c1 + 1) * lag - first].reshape(-1, lag)
            dev = np.cumsum(part - part.mean(axis=1, keepdims=True), axis=1)
            span = dev.max(axis=1) - dev.min(axis=1)
            std = part.std(axis=1, ddof=1 if sample else 0)
            rs = span[std > 0] / std[std > 0] if sample else span / (std + 1e-10)
            if len(rs):
                lags.append(lag)
                sums.append(float(rs.sum()))
                counts.append(len(rs))
        return pd.DataFrame(
            {"symbol": pdf["symbol"].iloc[0], "timeframe": pdf["timeframe"].iloc[0], "lag": lags, "s": sums, "c": counts}
        ).astype({"lag": "int64", "s": "float64", "c": "int64"})

    parts = rows.select(*KEYS, "_blk", "_rn", "_own", "_total", "x").groupBy(*KEYS, "_blk")
    per_lag = (
        parts.applyInPandas(ranges, f"{KEY_SCHEMA}, lag bigint, s double, c bigint")
        .groupBy(*KEYS, "lag")
        .agg((F.sum("s") / F.sum("c")).alias("rs"))
    )
    log_rs, log_lag = F.ln("rs"), F.ln("lag")
    fit = per_lag.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_k"), F.regr_slope(log_rs, log_lag).alias("h"))
    h = F.when(F.col("_k") < (5 if sample else 2), F.lit(0.5)).otherwise(F.col("h"))
    if sample:
        h = F.greatest(F.lit(0.0), F.least(F.lit(1.0), h))
    known = df.filter(F.col(column).isNotNull()).select(*KEYS).distinct()
    out = known.join(fit, KEYS, "left").withColumn("hurst", F.coalesce(h, F.lit(0.5)))
    label = F.when(F.col("hurst") > 0.55, "trending").when(F.col("hurst") < 0.45, "mean-reverting").otherwise("random walk")
    return out.select(*KEYS, "hurst", label.alias("interpretation"))


# Response surface of the ADF test with constant (MacKinnon 1994, 2010).
ADF_TAU = (-18.83, -1.61, 2.74)
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_CRITICAL = {
    "critical_1pct": (-3.43035, -6.5393, -16.786, -79.433),
    "critical_5pct": (-2.86154, -2.8903, -4.234, -40.04),
}


def adf_p_value(stat: float) -> float:
    low, star, high = ADF_TAU
    if stat > high:
        return 1.0
    if stat < low:
        return 0.0
    coef = ADF_SMALL if stat <= star else ADF_LARGE
    return normal_cdf(sum(c * stat**i for i, c in enumerate(coef)))


def adf_max_lag(n: int) -> int:
    return min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2)


def _adf_design(y: np.ndarray, p: int, start: int) -> np.ndarray:
    """Rows t = start.. of [dy_t, y_(t-1), 1, dy_(t-1) .. dy_(t-p)] for the values ``y``."""
    dy = np.diff(y)
    t = np.arange(start, len(y))
    cols = [dy[t - 1], y[t - 1], np.ones(len(t))] + [dy[t - 1 - j] for j in range(1, p + 1)]
    return np.column_stack(cols)


def _adf_solve(gram: np.ndarray, lags: int) -> tuple[float, float, float]:
    """t statistic of y_(t-1), residual sum of squares and row count of the regression on ``lags`` lags."""
    k = lags + 3
    xtx, xty, n = gram[1:k, 1:k], gram[1:k, 0], gram[2, 2]
    inv = np.linalg.pinv(xtx)
    beta = inv @ xty
    ssr = max(float(gram[0, 0] - beta @ xty), 0.0)
    var = ssr / (n - (k - 1)) if n > k - 1 else float("nan")
    se = math.sqrt(max(var * inv[0, 0], 0.0)) if var == var else float("nan")
    return (float(beta[0]) / se if se else float("nan")), ssr, float(n)


def adf_test(
    df: DataFrame, column: str = "close", layout: Layout = DEFAULT, keys=SERIES, least: int = 12, time: str = TIME
) -> DataFrame:
    """Augmented Dickey-Fuller test with constant; the number of lags minimises the AIC.

    Every block adds its rows to the cross-product matrix of the regression with the most lags;
    the matrices are summed per series. The regressions with fewer lags are sub-matrices, and the
    final one adds the few first rows that the common sample leaves out.
    """
    keys = list(keys)
    x = df.filter(F.col(column).isNotNull()).select(*keys, time, F.col(column).cast("double").alias("x"))
    size = cut(x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("_m")))
    longest = size.agg(F.max("n")).first()[0] or 0
    halo = max(adf_max_lag(longest), 1) + 1 if longest else 1
    indexed = index_series(x, layout=layout, attributes=size.select(*keys, "_m"), only=F.col("_total") >= least, keys=keys, time=time)
    rows = row_blocks(indexed, halo, layout)
    key_schema = ", ".join(f"{k} string" for k in keys)

    def cross(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rn")
        # a shift of the level only changes the constant and keeps the products small
        y, own, rn = pdf["x"].to_numpy() - pdf["_m"].iloc[0], pdf["_own"].to_numpy(), pdf["_rn"].to_numpy()
        p = adf_max_lag(int(pdf["_total"].iloc[0]))
        first = int(np.argmax(own))
        z = _adf_design(y, p, max(first, p + 1 - int(rn[0])))
        gram = (z.T @ z).ravel()
        head = y[: p + 1] if rn[0] == 0 else np.empty(0)
        out = pd.DataFrame(
            {
                "kind": ["g"] * len(gram) + ["y"] * len(head),
                "pos": [*range(len(gram)), *range(len(head))],
                "v": np.concatenate([gram, head]),
            }
        )
        out["n"] = int(pdf["_total"].iloc[0])
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, "n", "kind", "pos", "v"]]

    parts = rows.select(*keys, "_blk", "_rn", "_own", "_total", "_m", "x").groupBy(*keys, "_blk")
    entries = (
        parts.applyInPandas(cross, f"{key_schema}, n bigint, kind string, pos bigint, v double")
        .groupBy(*keys, "n", "kind", "pos")
        .agg(F.sum("v").alias("v"))
    )

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].iloc[0])
        p = adf_max_lag(n)
        g = pdf[pdf["kind"] == "g"].sort_values("pos")["v"].to_numpy().reshape(p + 3, p + 3)
        head = pdf[pdf["kind"] == "y"].sort_values("pos")["v"].to_numpy()
        best, best_aic = 0, None
        for lags in range(p + 1):
            _, ssr, rows_ = _adf_solve(g, lags)
            aic = rows_ * (math.log(2 * math.pi * ssr / rows_) + 1) + 2 * (lags + 2) if ssr > 0 else -math.inf
            if best_aic is None or aic < best_aic:
                best, best_aic = lags, aic
        extra = _adf_design(head, best, best + 1)
        k = best + 3
        stat, _, used = _adf_solve(g[:k, :k] + extra.T @ extra, best)
        row = {k_: pdf[k_].iloc[0] for k_ in keys}
        row |= {"n": n, "lags": best, "statistic": stat, "p_value": adf_p_value(stat) if stat == stat else float("nan")}
        for name, c in ADF_CRITICAL.items():
            row[name] = sum(v / used**i for i, v in enumerate(c))
        return pd.DataFrame([row])

    out = entries.groupBy(*keys).applyInPandas(
        solve,
        f"{key_schema}, n bigint, lags bigint, statistic double, p_value double, critical_1pct double, critical_5pct double",
    )
    return out.withColumn("is_stationary", F.col("p_value") < 0.05)


def unpivot(df: DataFrame, features: list[str]) -> DataFrame:
    """Long form (series, time, feature, value) of the non-null feature values."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    return (
        df.select(*KEYS, TIME, F.explode(pairs).alias("_f"))
        .select(*KEYS, TIME, "_f.feature", "_f.value")
        .filter(F.col("value").isNotNull())
    )


def adf_by_feature(df: DataFrame, features: list[str], layout: Layout = DEFAULT) -> DataFrame:
    """ADF test of every feature column with at least 30 values."""
    return adf_test(unpivot(df, features), "value", layout, keys=(*SERIES, "feature"), least=30)


def feature_distribution(df: DataFrame, features: list[str]) -> DataFrame:
    """Mean, deviation, skewness and kurtosis of every feature with at least 10 values."""
    n = F.col("n")
    agg = unpivot(df, features).groupBy(*KEYS, "feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.skewness("value").alias("skewness"),
        F.kurtosis("value").alias("kurtosis"),
    )
    return agg.filter(n >= 10).withColumns(
        {"skewness": sample_skew(n, F.col("skewness")), "kurtosis": sample_kurtosis(n, F.col("kurtosis"))}
    )


def return_histogram(df: DataFrame, column: str = "log_return", bins: int = 80) -> DataFrame:
    """Density histogram over equal-width bins between the extremes of each series."""
    x = _present(df, column)
    span = x.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).filter("hi > lo")
    width = (F.col("hi") - F.col("lo")) / bins
    number = F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))
    out = x.join(span, KEYS).groupBy(*KEYS, number.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.first("n").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi")
    )
    left = F.col("lo") + F.col("bin") * width
    return out.select(*KEYS, "bin", "count", left.alias("left"), (F.col("count") / (F.col("n") * width)).alias("density"))


def _grid(lo: Column, hi: Column, points: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(points - 1)),
        lambda i: F.struct(i.cast("bigint").alias("i"), (lo + i * (hi - lo) / (points - 1)).alias("x")),
    )


def normal_overlay(df: DataFrame, column: str = "log_return", points: int = 200) -> DataFrame:
    """Normal density with the mean and deviation of the series on a grid between its extremes."""
    s = df.filter(F.col(column).isNotNull()).groupBy(*KEYS).agg(
        F.avg(column).alias("m"), F.stddev_samp(column).alias("s"), F.min(column).alias("lo"), F.max(column).alias("hi")
    )
    g = s.filter("s > 0").select(*KEYS, "m", "s", F.explode(_grid(F.col("lo"), F.col("hi"), points)).alias("_g"))
    z = (F.col("_g.x") - F.col("m")) / F.col("s")
    return g.select(*KEYS, F.col("_g.i").alias("i"), F.col("_g.x").alias("x"), (F.exp(-z * z / 2) / (F.col("s") * math.sqrt(2 * math.pi))).alias("pdf"))


def kde_grid(df: DataFrame, column: str = "log_return", points: int = 200, quantile_range: bool = False) -> DataFrame:
    """Gaussian kernel density (Scott bandwidth) on a grid.

    The grid of a series is an attribute of its rows; each task adds up the kernels of its rows
    for all grid points, so ``points`` partial sums per series and task are shuffled.
    """
    x = _present(df, column)
    s = x.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    if quantile_range:
        s = s.drop("lo", "hi").join(exact_quantiles(x, KEYS, "x", {"lo": 0.001, "hi": 0.999}).drop("n"), KEYS)
    s = s.filter("s > 0").withColumn("h", F.col("s") * F.pow(F.col("n").cast("double"), -0.2))

    def kernels(batches):
        for pdf in batches:
            parts = []
            for (sym, tf), g in pdf.groupby(["symbol", "timeframe"], sort=False):
                lo, hi, h, n = (float(g[c].iloc[0]) for c in ("lo", "hi", "h", "n"))
                grid = lo + np.arange(points) * (hi - lo) / (points - 1)
                z = (grid[:, None] - g["x"].to_numpy()[None, :]) / h
                parts.append(
                    pd.DataFrame(
                        {"symbol": sym, "timeframe": tf, "i": np.arange(points), "x": grid,
                         "d": np.exp(-z * z / 2).sum(axis=1) / (n * h * math.sqrt(2 * math.pi))}
                    )
                )
            if parts:
                yield pd.concat(parts)

    out = x.join(s, KEYS).select(*KEYS, "x", "lo", "hi", "h", "n").mapInPandas(kernels, f"{KEY_SCHEMA}, i bigint, x double, d double")
    return out.groupBy(*KEYS, "i").agg(F.max("x").alias("x"), F.sum("d").alias("density"))


def qq_points(df: DataFrame, column: str = "log_return", layout: Layout = DEFAULT) -> DataFrame:
    """Normal probability plot: theoretical and ordered values, with slope, intercept and r of the fit.

    Ranks come from ``rank_values``, so no task sorts a whole series.
    """
    ranked = rank_values(_present(df, column), layout)
    n, i = F.col("n"), F.col("rank")
    edge = F.pow(F.lit(0.5), 1.0 / n)
    m = F.when(i == 1, 1 - edge).when(i == n, edge).otherwise((i - 0.3175) / (n + 0.365))

    @F.pandas_udf("double")
    def quantile(p: pd.Series) -> pd.Series:
        from statistics import NormalDist

        inv = NormalDist().inv_cdf
        return p.map(inv)

    pts = ranked.filter(n > 1).select(*KEYS, TIME, "rank", quantile(m).alias("theoretical"), F.col("x").alias("ordered"))
    fit = pts.groupBy(*KEYS).agg(
        F.regr_slope("ordered", "theoretical").alias("slope"),
        F.regr_intercept("ordered", "theoretical").alias("intercept"),
        F.corr("ordered", "theoretical").alias("r"),
    )
    return pts.join(fit, KEYS)


def rank_values(x: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """1-based rank of ``x`` per series (ties by time) and the series size ``n``.

    Approximate quantiles split a series into 256 ranges of about equal counts, and each range is
    cut into equal-width bins, about one per 50,000 rows. A frequent value is a splitter itself; its
    rows are ordered by time and cut by time bucket. Only the bin counts are scanned per series.
    """
    from wickframe.operators.blocks import time_bucket

    probs = [k / 256 for k in range(1, 256)]
    sp = x.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("x").alias("_lo"),
        F.max("x").alias("_hi"),
        F.array_distinct(F.percentile_approx("x", probs, 2_560)).alias("_sp"),
    )
    width = 1 << 24

    def place(batches):
        for pdf in batches:
            out = np.zeros(len(pdf), dtype="int64")
            for _, pos in pdf.groupby(["symbol", "timeframe"], sort=False).indices.items():
                v = pdf["x"].to_numpy()[pos]
                head = pdf.iloc[pos[0]]
                edges = np.asarray(head["_sp"], dtype=float)
                bins = min(max(int(head["n"]) // len(edges) // 50_000, 1), width - 1)
                left = np.searchsorted(edges, v, "left")
                is_edge = np.searchsorted(edges, v, "right") > left
                ext = np.concatenate([[head["_lo"]], edges, [head["_hi"]]])
                lo, hi = ext[left], ext[left + 1]
                part = np.where(hi > lo, (v - lo) / np.where(hi > lo, hi - lo, 1.0), 0.0)
                sub = np.minimum((part * bins).astype("int64"), bins - 1)
                # odd ranges are exactly a splitter, even ones lie between two
                out[pos] = (2 * left + is_edge) * width + np.where(is_edge, 0, sub)
            pdf["_vb"] = out
            yield pdf.drop(columns=["_sp", "_lo", "_hi"])

    schema = f"{KEY_SCHEMA}, {TIME} timestamp, x double, n bigint, _vb bigint"
    placed = x.join(sp, KEYS).select(*KEYS, TIME, "x", "n", "_sp", "_lo", "_hi").mapInPandas(place, schema)
    is_value = F.floor(F.col("_vb") / width) % 2 == 1
    placed = placed.withColumn("_tb", F.when(is_value, time_bucket(layout.span)).otherwise(F.lit(0)))
    part = placed.groupBy(*KEYS, "_vb", "_tb").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*KEYS).orderBy("_vb", "_tb").rowsBetween(Window.unboundedPreceding, -1)
    off = part.select(*KEYS, "_vb", "_tb", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*KEYS, "_vb", "_tb").orderBy("x", TIME)
    return (
        placed.join(off, [*KEYS, "_vb", "_tb"])
        .withColumn("rank", F.row_number().over(w) + F.col("_off"))
        .select(*KEYS, TIME, "x", "n", "rank")
    )


def diagnostics_report(df: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """All statistics of a series in one row; ``df`` has ``close`` and ``log_return``."""

    def named(t: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
        return t.select(*KEYS, *[F.col(c).alias(f"{prefix}_{c}") for c in cols])

    tests = ["statistic", "p_value", "is_stationary"]
    df = cut(df.select(*KEYS, TIME, "close", "log_return"))
    parts = [
        value_at_risk(df),
        named(adf_test(df, "close", layout), "adf_price", tests),
        named(adf_test(df, "log_return", layout), "adf_return", tests),
        named(kpss_test(df, "close", layout), "kpss_price", tests),
        named(kpss_test(df, "log_return", layout), "kpss_return", tests),
        named(ljung_box(df, layout=layout), "ljung_box", ["statistic", "p_value", "has_autocorr"]),
        named(jarque_bera(df), "jarque_bera", ["statistic", "p_value", "is_normal"]),
        hurst_rs(df, layout=layout).select(*KEYS, "hurst", "interpretation"),
    ]
    out = return_stats(df)
    for p in parts:
        out = out.join(p, KEYS, "left")
    return out
