"""Scores of forecasts, conformal intervals and combinations of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickframe.operators.blocks import DEFAULT, Layout, index_series, over_block
from wickframe.operators.features import Indicator, with_indicators
from wickframe.operators.quantiles import exact_quantiles
from wickframe.operators.scans import Ewm
from wickframe.schema import SERIES, TIME, step_ms

EPS = 1e-8
# Quantile levels and their column names.
QUANTILES = {"q02": 0.02, "q10": 0.10, "q25": 0.25, "q50": 0.50, "q75": 0.75, "q90": 0.90, "q98": 0.98}


def point_metrics(df: DataFrame, y: str = "y", yhat: str = "y_pred", by=SERIES) -> DataFrame:
    """MAE, RMSE, MAPE %, sMAPE % and R2 (0 where the actual values do not vary)."""
    a, p = F.col(y), F.col(yhat)
    e = F.abs(a - p)
    ss_tot = F.var_pop(a) * F.count(F.lit(1))
    return df.filter(a.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(e).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(e / (F.abs(a) + EPS)) * 100).alias("mape"),
        (F.avg(e / ((F.abs(a) + F.abs(p)) / 2 + EPS)) * 100).alias("smape"),
        F.when(ss_tot < 1e-10, F.lit(0.0)).otherwise(1 - F.try_divide(F.sum(e * e), ss_tot)).alias("r2"),
    )


def interval_metrics(df: DataFrame, y: str = "y", levels: dict[int, tuple[str, str]] | None = None, by=SERIES) -> DataFrame:
    """Winkler score and coverage % of each interval; ``levels`` maps percent to (lower, upper) columns."""
    levels = levels or {80: ("lower_80", "upper_80"), 90: ("lower_90", "upper_90")}
    aggs = []
    for pct, (lo, hi) in levels.items():
        a, low, high = F.col(y), F.col(lo), F.col(hi)
        rate = 2.0 / round(1 - pct / 100, 10)
        miss = F.when(a < low, rate * (low - a)).when(a > high, rate * (a - high)).otherwise(0.0)
        aggs.append(F.avg(high - low + miss).alias(f"winkler_{pct}"))
        aggs.append((F.avg(((a >= low) & (a <= high)).cast("double")) * 100).alias(f"coverage_{pct}"))
    return df.groupBy(*by).agg(*aggs)


def quantile_loss(df: DataFrame, y: str = "y", quantiles: dict[str, float] | None = None, by=SERIES) -> DataFrame:
    """Mean pinball loss per quantile and over all of them."""
    quantiles = quantiles or QUANTILES
    losses = {c: F.greatest(q * (F.col(y) - F.col(c)), (q - 1) * (F.col(y) - F.col(c))) for c, q in quantiles.items()}
    out = df.groupBy(*by).agg(*[F.avg(x).alias(f"loss_{c}") for c, x in losses.items()])
    total = sum((F.col(f"loss_{c}") for c in losses), F.lit(0.0))
    return out.withColumn("loss", total / len(losses))


def conformal_quantiles(calibration: DataFrame, y: str = "y", yhat: str = "y_pred", alpha: float = 0.1) -> DataFrame:
    """80 %, 1 - alpha and 95 % quantile of the absolute residuals of held-out calibration rows, per series."""
    r = calibration.withColumn("_r", F.abs(F.col(y) - F.col(yhat)))
    return exact_quantiles(r, SERIES, "_r", {"q80": 0.80, "q90": 1 - alpha, "q95": 0.95})


def conformal_intervals(predictions: DataFrame, quantiles: DataFrame, yhat: str = "y_pred") -> DataFrame:
    """Symmetric 80 % and 90 % intervals around the predictions."""
    p = F.col(yhat)
    out = predictions.join(quantiles.select(*SERIES, "q80", "q90"), list(SERIES), "left")
    cols = {f"{side}_{k}": p + s * F.col(f"q{k}") for k in (80, 90) for side, s in (("lower", -1), ("upper", 1))}
    return out.withColumns(cols).drop("q80", "q90")


def forecast_timestamps(forecast: DataFrame, last: DataFrame) -> DataFrame:
    """Time of each forecast step, and its distance to the last close.

    ``last`` has the newest candle of every series (``latest_price``).
    """
    base = last.select(*SERIES, F.col(TIME).alias("_t"), F.col("close").alias("last_close"))
    step = F.coalesce(step_ms(), F.lit(86_400_000))
    out = forecast.join(base, list(SERIES))
    diff = F.col("y_pred") - F.col("last_close")
    return out.withColumns(
        {
            "forecast_time": F.timestamp_millis(F.unix_millis("_t") + F.col("step") * step),
            "diff": diff,
            "diff_pct": F.try_divide(diff, F.col("last_close")) * 100,
        }
    ).drop("_t")


def baseline_forecasts(df: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """One-step scores of the naive, SMA-7, SMA-25 and EWM-14 forecasts.

    A forecast uses the bars before the one it is compared with.
    """
    w = over_block()

    def mean_before(n: int) -> Column:
        return F.when(F.col("_rn") >= n, F.avg("close").over(w.rowsBetween(-n, -1)))

    spec = Indicator(
        ("naive", "sma_7", "sma_25", "ewm_14"),
        {
            0: {"naive": F.lag("close").over(w), "sma_7": mean_before(7), "sma_25": mean_before(25), "_e": Ewm.span("close", 14)},
            1: {"ewm_14": F.lag("_e").over(w)},
        },
        26,
    )
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("y_pred")) for m in spec.outputs])
    long = with_indicators(df, [spec], layout).select(*SERIES, F.col("close").alias("y"), F.explode(models).alias("_m"))
    return point_metrics(long.select(*SERIES, "y", "_m.*"), by=(*SERIES, "model")).drop("smape", "r2")


def quantile_forecast(df: DataFrame, horizon: int = 7, layout: Layout = DEFAULT) -> DataFrame:
    """Quantiles of the h-step log return, per series, trend regime and step.

    ``df`` has ``close`` and ``regime``. A series in some regime now is forecast by what followed
    its earlier bars in that regime.
    """
    w = over_block()
    steps = {f"_h{h}": F.ln(F.try_divide(F.lead("close", h).over(w), F.col("close"))) for h in range(1, horizon + 1)}
    rows = with_indicators(df, [Indicator(tuple(steps), {0: steps}, 0)], layout, ahead=horizon)
    pairs = F.array(*[F.struct(F.lit(h).cast("bigint").alias("step"), F.col(f"_h{h}").alias("_r")) for h in range(1, horizon + 1)])
    long = rows.select(*SERIES, "regime", F.explode(pairs).alias("_p")).select(*SERIES, "regime", "_p.*")
    return exact_quantiles(long, (*SERIES, "regime", "step"), "_r", QUANTILES)


def reconstruct_close(forecast: DataFrame, context: DataFrame, encoder: int = 30, layout: Layout = DEFAULT) -> DataFrame:
    """Closes from predicted log returns: base close times the exponential of their running sum.

    The base of window w is the close of row ``min(w + encoder - 1, last)`` of the context.
    """
    idx = index_series(context.select(*SERIES, TIME, "close"), layout=layout)
    ends = forecast.select(*SERIES, "window").distinct()
    size = idx.groupBy(*SERIES).agg(F.max("_total").alias("_n"))
    at = ends.join(size, list(SERIES)).withColumn("_rn", F.least(F.col("window") + encoder - 1, F.col("_n") - 1)).drop("_n")
    base = at.join(idx.select(*SERIES, "_rn", F.col("close").alias("_base")), [*SERIES, "_rn"]).drop("_rn")
    w = Window.partitionBy(*SERIES, "window").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)  # one window: a few steps
    out = forecast.join(base, [*SERIES, "window"])
    return out.withColumns({f"close_{q}": F.col("_base") * F.exp(F.sum(q).over(w)) for q in ("q50", "q10", "q90")}).drop("_base")


def ensemble_mean(predictions: DataFrame, losses: DataFrame, n_best: int = 3, columns=tuple(QUANTILES)) -> DataFrame:
    """Mean prediction of the ``n_best`` models with the lowest validation loss.

    ``losses`` (model, val_loss) has one row per trained model; ties are broken by name.
    """
    best = losses.orderBy("val_loss", "model").limit(n_best).select("model")
    return predictions.join(best, "model", "left_semi").groupBy(*SERIES, "window", "step").agg(*[F.avg(c).alias(c) for c in columns])


def cv_summary(folds: DataFrame, column: str = "val_loss", by=()) -> DataFrame:
    return folds.filter(F.col(column).isNotNull()).groupBy(*by).agg(
        F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"), F.count(column).alias("folds")
    )
