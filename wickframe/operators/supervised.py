"""Lagged features, targets, windows and time-ordered folds for forecasting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickframe.operators.blocks import DEFAULT, Layout, drop_index, index_series, over_block, rolled
from wickframe.operators.features import Indicator, ffill_zero, with_indicators
from wickframe.operators.scans import Ewm
from wickframe.schema import SERIES, TIME

LAGS = (1, 2, 3, 5, 7, 14, 21)
ROLLS = (7, 14, 30)
SPANS = (7, 14)
ENCODER, HORIZON = 30, 7


def _lags_def(t: str, lags=LAGS) -> Indicator:
    cols = {f"{t}_lag_{k}": F.lag(t, k).over(over_block()) for k in lags}
    return Indicator(tuple(cols), {0: cols}, max(lags))


def _rolls_def(t: str, windows=ROLLS) -> Indicator:
    cols: dict[str, Column] = {}
    for n in windows:
        least = max(1, n // 2)
        cols[f"{t}_roll_mean_{n}"] = rolled(F.avg, t, n, least)
        cols[f"{t}_roll_std_{n}"] = rolled(F.stddev_samp, t, n, least)
        if n <= 14:
            cols[f"{t}_roll_min_{n}"] = rolled(F.min, t, n, least)
            cols[f"{t}_roll_max_{n}"] = rolled(F.max, t, n, least)
    return Indicator(tuple(cols), {0: cols}, max(windows))


def _ewma_def(t: str, spans=SPANS) -> Indicator:
    cols = {f"{t}_ewma_{s}": Ewm.span(t, s) for s in spans}
    return Indicator(tuple(cols), {0: cols})


def _diffs_def(t: str) -> Indicator:
    x = F.col(t)
    one, seven = F.lag(t, 1).over(over_block()), F.lag(t, 7).over(over_block())
    cols = {f"{t}_diff_1": x - one, f"{t}_diff_7": x - seven, f"{t}_mom_7": x - seven}
    return Indicator(tuple(cols), {0: cols}, 7)


def lag_features(df: DataFrame, target: str = "close", lags=LAGS, layout: Layout = DEFAULT) -> DataFrame:
    return with_indicators(df, [_lags_def(target, lags)], layout)


def rolling_features(df: DataFrame, target: str = "close", windows=ROLLS, layout: Layout = DEFAULT) -> DataFrame:
    """Rolling mean and deviation, and extremes of the short windows; half a window is enough."""
    return with_indicators(df, [_rolls_def(target, windows)], layout)


def ewma_features(df: DataFrame, target: str = "close", spans=SPANS, layout: Layout = DEFAULT) -> DataFrame:
    return with_indicators(df, [_ewma_def(target, spans)], layout)


def diff_momentum(df: DataFrame, target: str = "close", layout: Layout = DEFAULT) -> DataFrame:
    return with_indicators(df, [_diffs_def(target)], layout)


def build_lag_features(
    df: DataFrame, target: str = "close", drop_na: bool = True, layout: Layout = DEFAULT, ahead_of: int = 0
) -> DataFrame:
    """All lagged features in one pass. ``ahead_of`` adds ``y``, the target that many rows later.

    The target is built before any split or row removal, so it is always exactly that far away.
    """
    if target not in df.columns:
        raise ValueError(f"target column {target} not found")
    parts = [_lags_def(target), _rolls_def(target), _ewma_def(target), _diffs_def(target)]
    features = [o for p in parts for o in p.outputs]
    if ahead_of:
        parts.append(Indicator(("y",), {0: {"y": F.lead(target, ahead_of).over(over_block())}}))
    out = with_indicators(df, parts, layout, ahead=ahead_of)
    return out.dropna(subset=[*[c for c in df.columns], *features]) if drop_na else out


def feature_columns(df: DataFrame, target: str = "close", exclude=("y",)) -> list[str]:
    """Numeric columns that may serve as inputs."""
    skip = {target, *SERIES, TIME, *exclude}
    return [c for c, t in df.dtypes if c not in skip and t in ("double", "float", "int", "bigint")]


def make_supervised(df: DataFrame, target: str = "close", horizon: int = 1, layout: Layout = DEFAULT) -> DataFrame:
    """Inputs and ``y`` = target ``horizon`` rows later; rows without target are removed."""
    features = feature_columns(df, target)
    if horizon == 0:
        return df.withColumn("y", F.col(target)).select(*SERIES, TIME, *features, "y")
    lead = Indicator(("y",), {0: {"y": F.lead(target, horizon).over(over_block())}})
    out = with_indicators(df, [lead], layout, ahead=horizon)
    return out.filter(F.col("y").isNotNull()).select(*SERIES, TIME, *features, "y")


def future_return(df: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Log return of the next bar."""
    up = F.ln(F.try_divide(F.lead("close", 1).over(over_block()), F.col("close")))
    return with_indicators(df, [Indicator(("future_return",), {0: {"future_return": up}})], layout, ahead=1)


def time_index(df: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """0-based position of each row in its series."""
    return drop_index(index_series(df, layout=layout).withColumn("time_idx", F.col("_rn")))


def sequence_windows(
    df: DataFrame, target: str = "close", encoder: int = ENCODER, horizon: int = HORIZON, layout: Layout = DEFAULT
) -> DataFrame:
    """One row per window: the last ``encoder`` values (at least half) and the next 1..horizon targets."""
    w = over_block()
    arrays = {
        "encoder": F.collect_list(target).over(w.rowsBetween(-(encoder - 1), 0)),
        "decoder": F.collect_list(target).over(w.rowsBetween(1, horizon)),
    }
    spec = Indicator(tuple(arrays), {0: arrays}, encoder)
    out = with_indicators(df.select(*SERIES, TIME, target), [spec], layout, ahead=horizon)
    return out.filter((F.size("encoder") >= max(1, encoder // 2)) & (F.size("decoder") >= 1)).drop(target)


def encoder_normalize(windows: DataFrame, eps: float = 1e-8) -> DataFrame:
    """Standardise a window by mean and population deviation of its encoder part."""
    n = F.size("encoder")
    mean = F.aggregate("encoder", F.lit(0.0), lambda a, x: a + x) / n
    out = windows.withColumn("center", mean)
    var = F.aggregate(F.transform("encoder", lambda x: (x - F.col("center")) * (x - F.col("center"))), F.lit(0.0), lambda a, x: a + x)
    out = out.withColumn("scale", F.sqrt(var / n) + eps)

    def scaled(c):
        return F.transform(c, lambda x: (x - F.col("center")) / F.col("scale"))

    return out.withColumns({"encoder": scaled("encoder"), "decoder": scaled("decoder")})


def prepare_series(df: DataFrame, default_symbol: str = "BTC/USDT", timeframe: str = "1d", layout: Layout = DEFAULT) -> DataFrame:
    """Keys and typed time, rows without time removed, gaps filled forward per series and then with 0."""
    if "symbol" not in df.columns:
        df = df.withColumn("symbol", F.lit(default_symbol))
    if "timeframe" not in df.columns:
        df = df.withColumn("timeframe", F.lit(timeframe))
    types = dict(df.dtypes)
    t = F.col(TIME).cast("timestamp") if types[TIME].startswith("timestamp") else F.expr(f"try_cast({TIME} as timestamp)")
    df = df.withColumns({"symbol": F.col("symbol").cast("string"), TIME: t}).filter(F.col(TIME).isNotNull())
    rest = [c for c in df.columns if c not in (*SERIES, TIME)]
    return ffill_zero(df, rest, layout)


def time_series_folds(df: DataFrame, k: int = 5, layout: Layout = DEFAULT) -> DataFrame:
    """``fold`` = number of the expanding fold whose test block holds the row, 0 for rows only trained on.

    A fold's training rows are all rows with a smaller fold number.
    """
    size = F.floor(F.col("_total") / (k + 1))
    start = F.col("_total") - k * size
    fold = F.when((size > 0) & (F.col("_rn") >= start), F.floor((F.col("_rn") - start) / size) + 1).otherwise(0)
    return drop_index(index_series(df, layout=layout).withColumn("fold", fold.cast("bigint")))


def walk_forward_folds(df: DataFrame, k: int = 5, encoder: int = ENCODER, horizon: int = HORIZON) -> DataFrame:
    """Row ranges of the walk-forward folds per series; validation starts with encoder context.

    Short series get fewer folds. A fold that would end at the last row is left out.
    """
    least = 3 * encoder
    size = df.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n"))
    free = F.col("n") - least
    few = F.floor(free / k) < horizon
    splits = F.when(few, F.greatest(F.lit(2), F.floor(free / max(horizon, 1)))).otherwise(k)
    out = (
        size.filter(free > 0)
        .withColumn("_k", splits.cast("int"))
        .withColumn("_size", F.floor(free / F.col("_k")))
        .select(*SERIES, "n", "_size", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_f"))
    )
    start = least + F.col("_f") * F.col("_size")
    end = F.least(start + F.col("_size"), F.col("n"))
    context = F.greatest(F.lit(0), start - encoder)
    return out.filter(end < F.col("n")).select(
        *SERIES,
        (F.col("_f") + 1).cast("bigint").alias("fold"),
        start.alias("train_rows"),
        (start - 1).alias("train_end_idx"),
        context.alias("context_start_idx"),
        start.alias("val_start_idx"),
        (end - 1).alias("val_end_idx"),
        (end - context).alias("val_rows"),
    )


def walk_forward_rows(df: DataFrame, k: int = 5, encoder: int = ENCODER, horizon: int = HORIZON, layout: Layout = DEFAULT) -> DataFrame:
    """Rows of every fold with their role (train or val); context rows appear in both roles."""
    bounds = walk_forward_folds(df, k, encoder, horizon)
    idx = time_index(df, layout)
    ranged = idx.join(bounds, list(SERIES))
    i = F.col("time_idx")
    roles = F.array(
        F.when(i <= F.col("train_end_idx"), F.lit("train")),
        F.when((i >= F.col("context_start_idx")) & (i <= F.col("val_end_idx")), F.lit("val")),
    )
    return ranged.select(*idx.columns, "fold", F.explode(F.array_compact(roles)).alias("role"))
