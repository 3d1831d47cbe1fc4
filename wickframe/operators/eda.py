"""Exploratory tables: snapshots, seasonality, anomalies, regimes and relations between series."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickframe.functions.special import t_two_sided
from wickframe.operators.blocks import DEFAULT, Layout, Running, drop_index, index_series, own, rolling, row_blocks, top_per_series
from wickframe.operators.features import EPS
from wickframe.operators.quantiles import exact_quantiles
from wickframe.plans.lineage import written
from wickframe.operators.stats import unpivot
from wickframe.schema import CHART_BARS, DEFAULT_CHART_BARS, SERIES, TIME, lookup

KEYS = list(SERIES)

# Feature groups used by the analyses.
ANALYTICAL = (
    "return_pct", "log_return", "macd", "macd_signal", "macd_hist", "rsi_14", "bb_width", "bb_pct", "atr_14",
    "volume_ratio", "rolling_vol_30", "price_zscore", "drawdown_pct",
)
STABILITY = ("rsi_14", "bb_pct", "macd", "volume_ratio", "rolling_vol_30", "price_zscore", "atr_14", "bb_width")


def price_snapshot(df: DataFrame) -> DataFrame:
    """Last close, extremes, and return since the first close of the last bar's year."""
    years = df.groupBy(*KEYS, F.year(TIME).alias("_y")).agg(
        F.min_by("close", TIME).alias("_first"),
        F.max_by("close", TIME).alias("_last"),
        F.max("high").alias("_high"),
        F.min("low").alias("_low"),
    )
    out = years.groupBy(*KEYS).agg(
        F.max_by("_last", "_y").alias("last_close"),
        F.max("_high").alias("max_high"),
        F.min("_low").alias("min_low"),
        F.max_by("_first", "_y").alias("_first"),
    )
    return out.withColumn("ytd_return", (F.col("last_close") / F.nullif("_first", F.lit(0.0)) - 1) * 100).drop("_first")


def kpi_latest(df: DataFrame) -> DataFrame:
    """Latest bar of every series against the one before; RSI zone and MACD sign."""
    last = top_per_series(df, 2, [F.col(TIME).desc()])
    one = F.col("_r") == 1
    cols = {"price": "close", "high": "high", "low": "low", "volume": "volume", "rsi": "rsi_14", "macd_hist": "macd_hist"}
    agg = last.groupBy(*KEYS).agg(
        *[F.max(F.when(one, F.col(c))).alias(n) for n, c in cols.items()],
        F.max(F.when(F.col("_r") == 2, F.col("close"))).alias("_before"),
    )
    before = F.coalesce("_before", "price")
    zone = F.when(F.col("rsi") > 70, "overbought").when(F.col("rsi") < 30, "oversold").otherwise("neutral")
    return agg.withColumns(
        {
            "change_pct": (F.col("price") - before) / (before + EPS) * 100,
            "rsi_zone": zone,
            "macd_sign": F.when(F.col("macd_hist") >= 0, "up").otherwise("down"),
        }
    ).drop("_before")


def candle_direction(df: DataFrame) -> DataFrame:
    """Direction of each candle and the extent of body and wicks."""
    body = F.abs(F.col("close") - F.col("open"))
    return df.withColumns(
        {
            "is_up": F.col("close") >= F.col("open"),
            "body_bottom": F.least("open", "close"),
            "body_height": F.greatest(body, (F.col("high") - F.col("low")) * 0.005),
            "upper_wick": F.col("high") - F.greatest("open", "close"),
            "lower_wick": F.least("open", "close") - F.col("low"),
        }
    )


def candle_window(df: DataFrame) -> DataFrame:
    """The newest bars of every series, as many as its timeframe shows on a chart."""
    most = max(*CHART_BARS.values(), DEFAULT_CHART_BARS)
    rows = top_per_series(df, most, [F.col(TIME).desc()])
    return rows.filter(F.col("_r") <= lookup(CHART_BARS, "timeframe", DEFAULT_CHART_BARS)).drop("_r")


def band_breakouts(df: DataFrame) -> DataFrame:
    side = F.when(F.col("close") > F.col("bb_upper"), "above").when(F.col("close") < F.col("bb_lower"), "below")
    return df.withColumn("side", side).filter(F.col("side").isNotNull())


def rsi_zones(df: DataFrame, high: float = 70.0, low: float = 30.0) -> DataFrame:
    """How far RSI lies above ``high`` or below ``low``."""
    rsi = F.col("rsi_14")
    return df.filter(rsi.isNotNull()).withColumns(
        {
            "overbought": F.greatest(rsi - high, F.lit(0.0)),
            "oversold": F.greatest(low - rsi, F.lit(0.0)),
            "zone": F.when(rsi > high, "overbought").when(rsi < low, "oversold").otherwise("neutral"),
        }
    )


def cumulative_return(df: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Running product of ``1 + return``, starting with the second bar of a series."""
    grown = F.ln(1 + F.col("return_pct") / 100)
    out = drop_index(index_series(df, {"_g": Running("sum", grown)}, layout=layout))
    return out.withColumn("cumulative_return", F.when(F.col("return_pct").isNotNull(), F.exp("_g"))).drop("_g")


def seasonality_dow(df: DataFrame) -> DataFrame:
    """Mean and quartiles of the return per weekday (Monday = 0)."""
    r = written(df.filter(F.col("return_pct").isNotNull()).select(*KEYS, F.weekday(TIME).cast("bigint").alias("day_of_week"), "return_pct"))
    group = [*KEYS, "day_of_week"]
    mean = r.groupBy(*group).agg(F.avg("return_pct").alias("mean_return"))
    return mean.join(exact_quantiles(r, group, "return_pct", {"q1": 0.25, "median": 0.5, "q3": 0.75}, stored=True), group)


def _pivot(df: DataFrame, row, column, values: list[int], prefix: str) -> DataFrame:
    r = df.filter(F.col("return_pct").isNotNull()).withColumns({"_row": row, "_col": column})
    out = r.groupBy(*KEYS, "_row").pivot("_col", values).agg(F.avg("return_pct"))
    return out.select(*KEYS, "_row", *[F.coalesce(F.col(str(v)), F.lit(0.0)).alias(f"{prefix}{v}") for v in values])


def seasonality_dow_hour(df: DataFrame) -> DataFrame:
    """Mean return by weekday and hour, missing cells 0."""
    out = _pivot(df, F.weekday(TIME).cast("bigint"), F.hour(TIME), list(range(24)), "h")
    return out.withColumnRenamed("_row", "day_of_week")


def seasonality_year_month(df: DataFrame) -> DataFrame:
    """Mean return by year and month, missing cells 0."""
    out = _pivot(df, F.year(TIME).cast("bigint"), F.month(TIME), list(range(1, 13)), "m")
    return out.withColumnRenamed("_row", "year")


def anomaly_zscore(df: DataFrame, threshold: float = 3.0) -> DataFrame:
    z = F.col("price_zscore")
    side = F.when(z > threshold, "high").when(z < -threshold, "low")
    return df.withColumn("side", side).filter(F.col("side").isNotNull())


def anomaly_counts(df: DataFrame, threshold: float = 3.0, volume_threshold: float = 3.0) -> DataFrame:
    z = F.col("price_zscore")
    return df.groupBy(*KEYS).agg(
        F.count_if(z > threshold).alias("z_high"),
        F.count_if(z < -threshold).alias("z_low"),
        F.count_if(F.col("volume_ratio") > volume_threshold).alias("volume_spikes"),
    )


def anomaly_volume_spike(df: DataFrame, threshold: float = 3.0) -> DataFrame:
    return df.filter(F.col("volume_ratio") > threshold)


def regime_share(df: DataFrame, column: str = "regime") -> DataFrame:
    """Bars and percentage of every regime per series."""
    n = df.groupBy(*KEYS, F.col(column).alias("regime")).agg(F.count(F.lit(1)).alias("bars"))
    total = F.sum("bars").over(Window.partitionBy(*KEYS))  # at most three rows per series
    return n.withColumn("pct", F.col("bars") / total * 100)


def _pair(df: DataFrame, a: str, b: str, columns: list[str]) -> DataFrame:
    def side(s, tag):
        return df.filter(F.col("symbol") == s).select("timeframe", TIME, *[F.col(c).alias(f"{c}_{tag}") for c in columns])

    both = side(a, "a").join(side(b, "b"), ["timeframe", TIME])
    return both.select(F.lit(f"{a}|{b}").alias("symbol"), "*")


def symbol_correlation(df: DataFrame, a: str, b: str, n: int = 30, least: int = 30, layout: Layout = DEFAULT) -> DataFrame:
    """Base-1 prices and rolling return correlation of two symbols on their common bars."""
    pair = _pair(df, a, b, ["close", "log_return"])
    first = {f"_first_{t}": Running("first", F.col(f"close_{t}")) for t in "ab"}
    rows = row_blocks(index_series(pair, first, layout=layout, only=F.col("_total") >= least), n, layout)
    ra, rb = F.col("log_return_a"), F.col("log_return_b")
    present = F.when(ra.isNotNull() & rb.isNotNull(), 1)
    w = rolling(n)
    rows = rows.withColumn("rolling_corr", F.when(F.count(present).over(w) >= n, F.corr(ra, rb).over(w)))
    return own(rows).select(
        *KEYS,
        TIME,
        (F.col("close_a") / F.col("_first_a")).alias("price_a"),
        (F.col("close_b") / F.col("_first_b")).alias("price_b"),
        "rolling_corr",
    )


def mean_correlation(correlation: DataFrame) -> DataFrame:
    return correlation.groupBy(*KEYS).agg(F.avg("rolling_corr").alias("mean_corr"), F.count("rolling_corr").alias("n"))


def beta_regression(df: DataFrame, a: str, b: str, p_value: bool = True) -> DataFrame:
    """Regression of the returns of ``b`` on those of ``a`` over common bars."""
    pair = _pair(df, a, b, ["log_return"]).dropna()
    y, x = "log_return_b", "log_return_a"
    out = pair.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.corr(y, x).alias("r"),
    )
    r, n = F.col("r"), F.col("n")
    out = out.withColumns({"r2": r * r, "t": r * F.sqrt(F.try_divide(n - 2, F.nullif(1 - r * r, F.lit(0.0))))})
    if not p_value:
        return out

    @F.pandas_udf("double")
    def tail(t: pd.Series, df_: pd.Series) -> pd.Series:
        return pd.Series([t_two_sided(x_, d) if d > 0 and x_ == x_ else math.nan for x_, d in zip(t, df_)])

    return out.withColumn("p_value", tail(F.col("t"), (n - 2).cast("double")))


def correlation_matrix(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every ordered feature pair over complete rows, in one aggregation."""
    feats = list(features or [c for c in ANALYTICAL if c in df.columns])
    rows = df.select(*KEYS, *feats).dropna()
    pairs = [(a, b) for i, a in enumerate(feats) for b in feats[i + 1 :]]
    agg = rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), *[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)]
    )
    cells = [F.struct(F.lit(f).alias("feature_a"), F.lit(f).alias("feature_b"), F.lit(1.0).alias("corr")) for f in feats]
    for i, (a, b) in enumerate(pairs):
        for u, v in ((a, b), (b, a)):
            cells.append(F.struct(F.lit(u).alias("feature_a"), F.lit(v).alias("feature_b"), F.col(f"_{i}").alias("corr")))
    return agg.select(*KEYS, "n", F.explode(F.array(*cells)).alias("_c")).select(*KEYS, "n", "_c.*")


def vif(df: DataFrame, features: list[str] | None = None, least: int = 50) -> DataFrame:
    """Variance inflation factors: diagonal of the inverse correlation matrix.

    A feature that is an exact combination of others has an infinite factor. The matrix of a series
    has one row per feature, so inverting it is small work per series.
    """
    feats = list(features or [c for c in ANALYTICAL if c in df.columns])
    corr = correlation_matrix(df, feats).filter(F.col("n") >= least)

    def invert(pdf: pd.DataFrame) -> pd.DataFrame:
        m = pdf.pivot(index="feature_a", columns="feature_b", values="corr").loc[feats, feats].to_numpy(dtype=float)
        ok = ~np.isnan(m).all(axis=1) & ~np.isnan(m).any(axis=1)
        values, vectors = np.linalg.eigh(np.where(np.isnan(m), 0.0, m))
        null = values < 1e-10 * max(values.max(), 1.0)
        dependent = (vectors[:, null] ** 2).sum(axis=1) > 1e-8
        diag = ((vectors[:, ~null] ** 2) / values[~null]).sum(axis=1)
        v = np.where(dependent, np.inf, diag)
        return pd.DataFrame(
            {"symbol": pdf["symbol"].iloc[0], "timeframe": pdf["timeframe"].iloc[0], "feature": feats, "vif": np.where(ok, v, np.nan)}
        )

    out = corr.groupBy(*KEYS).applyInPandas(invert, "symbol string, timeframe string, feature string, vif double")
    level = F.when(F.col("vif") > 10, "high").when(F.col("vif") > 5, "moderate").otherwise("ok")
    return out.filter(~F.isnan("vif")).withColumn("level", level)


def mutual_information(df: DataFrame, features: list[str], bins: int = 10) -> DataFrame:
    """Mutual information of each feature with the return and with the next return, over quantile bins.

    ``df`` has ``log_return`` and ``future_return``; its complete rows are written once, since edges and
    counts both read them. Counts per bin pair are combined before the
    shuffle: at most ``bins^2`` rows per series, feature and task.
    """
    rows = written(df.select(*KEYS, TIME, *features, F.col("log_return").alias("_now"), F.col("future_return").alias("_next")).dropna())
    long = unpivot(rows, [*features, "_now", "_next"])
    probs = {f"q{k}": k / bins for k in range(1, bins)}
    edges = exact_quantiles(long, [*KEYS, "feature"], "value", probs, stored=True)
    edges = edges.select(*KEYS, "feature", F.array(*probs).alias("edges"))
    per_series = edges.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(F.struct("feature", "edges"))).alias("_e"))

    def bin_of(feature: str, column: str):
        return F.size(F.filter(F.col("_e")[F.lit(feature)], lambda e: e < F.col(column)))

    cells = [
        F.struct(F.lit(f).alias("feature"), bin_of(f, f).alias("fb"), F.col("_b_now").alias("now"), F.col("_b_next").alias("next"))
        for f in features
    ]
    binned = rows.join(per_series, KEYS).withColumns({"_b_now": bin_of("_now", "_now"), "_b_next": bin_of("_next", "_next")})
    counts = (
        binned.select(*KEYS, F.explode(F.array(*cells)).alias("_c"))
        .groupBy(*KEYS, "_c.feature", "_c.fb", "_c.now", "_c.next")
        .agg(F.count(F.lit(1)).cast("double").alias("c"))
    )

    def information(target: str, name: str) -> DataFrame:
        joint = counts.groupBy(*KEYS, "feature", "fb", target).agg(F.sum("c").alias("c"))
        s = Window.partitionBy(*KEYS, "feature")  # at most bins^2 rows
        p = joint.withColumns(
            {
                "_n": F.sum("c").over(s),
                "_f": F.sum("c").over(Window.partitionBy(*KEYS, "feature", "fb")),
                "_t": F.sum("c").over(Window.partitionBy(*KEYS, "feature", target)),
            }
        )
        term = F.col("c") / F.col("_n") * F.ln(F.col("c") * F.col("_n") / (F.col("_f") * F.col("_t")))
        return p.groupBy(*KEYS, "feature").agg(F.sum(term).alias(name))

    out = information("now", "mi_current").join(information("next", "mi_future"), [*KEYS, "feature"])
    return out


def feature_stability(df: DataFrame, features: list[str] | None = None, layout: Layout = DEFAULT) -> DataFrame:
    """Rolling mean and deviation of each feature, with the overall mean of the series.

    The window is a tenth of the series, at least 20 and at most 90 bars.
    """
    feats = list(features or [c for c in STABILITY if c in df.columns])
    keys = (*SERIES, "feature")
    long = unpivot(df, feats)
    size = df.groupBy(*KEYS).agg(F.least(F.lit(90), F.greatest(F.lit(20), F.floor(F.count(F.lit(1)) / 10))).cast("bigint").alias("window"))
    mean = long.groupBy(*keys).agg(F.avg("value").alias("overall_mean")).join(size, KEYS)
    rows = row_blocks(index_series(long, keys=keys, attributes=mean, layout=layout), 90, layout)

    def roll(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rn")
        r = pdf["value"].rolling(int(pdf["window"].iloc[0]))
        pdf["rolling_mean"], pdf["rolling_std"] = r.mean(), r.std()
        return pdf.loc[pdf["_own"], [*keys, TIME, "window", "value", "rolling_mean", "rolling_std", "overall_mean"]]

    schema = f"symbol string, timeframe string, feature string, {TIME} timestamp, window bigint, value double, rolling_mean double, rolling_std double, overall_mean double"
    grouped = rows.select(*keys, TIME, "window", "value", "overall_mean", "_rn", "_own", "_blk").groupBy(*keys, "_blk")
    out = grouped.applyInPandas(roll, schema)
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("rolling_mean", "rolling_std")})
