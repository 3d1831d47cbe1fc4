"""Technical, risk and calendar features.

Every indicator is described by levels of columns: a level only reads columns of the levels below,
so all indicators that are asked for together share one blocked pass over the rows (one sort, one
window node per level) instead of one pass each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickframe.operators.blocks import (
    DEFAULT,
    Layout,
    Running,
    block_rows,
    drop_index,
    index_series,
    over_block,
    own,
    row_blocks,
)
from wickframe.operators.quantiles import exact_quantiles
from wickframe.operators.scans import Ewm, Roll, arranged, block_carry, with_scans
from wickframe.plans.lineage import written
from wickframe.schema import DEFAULT_PERIODS, OHLCV, PERIODS_PER_YEAR, SERIES, TIME, lookup, require

EPS = 1e-8
CORE = ("rsi_14", "macd", "bb_mid")  # fixed values


@dataclass(frozen=True)
class Indicator:
    """Columns by level, the preceding rows they need, and series-long running aggregates."""

    outputs: tuple[str, ...]
    levels: dict[int, dict[str, Column | Ewm | Roll]]
    halo: int = 0
    running: dict[str, Running] = field(default_factory=dict)


def with_indicators(
    df: DataFrame,
    indicators: list[Indicator],
    layout: Layout = DEFAULT,
    keep: tuple[str, ...] = (),
    attributes: DataFrame | None = None,
    only: Column | None = None,
    ahead: int = 0,
) -> DataFrame:
    """Compute several indicators in one pass and return the input columns plus their outputs.

    ``attributes`` and ``only`` are handed to ``index_series``; ``keep`` names further columns of
    the pass to return. Weighted means need what the block before hands over; that one row per block of a long
    series is computed and written when the function is called, so the planner sees how small it is.
    """
    levels: dict[int, dict] = {}
    for i in indicators:
        for n, cols in i.levels.items():
            levels.setdefault(n, {}).update(cols)
    halo = max([i.halo for i in indicators] + [c.halo + 1 for lv in levels.values() for c in lv.values() if isinstance(c, Roll)])
    running = {k: v for i in indicators for k, v in i.running.items()}
    base = [c for c in df.columns if c not in ("_rn", "_total")]
    scans = any(isinstance(c, (Ewm, Roll)) for lv in levels.values() for c in lv.values())

    def indexed(condition: Column | None) -> DataFrame:
        return index_series(df, running, layout=layout, attributes=attributes, only=condition)

    def computed(rows: DataFrame, carry: DataFrame | None, upto: float = math.inf) -> DataFrame:
        """All levels below ``upto`` and the plain columns of that level."""
        out = row_blocks(rows, halo, layout, ahead)
        out = arranged(out, SERIES, carry) if scans else out
        for n in sorted(lv for lv in levels if lv <= upto):
            plain = {k: c for k, c in levels[n].items() if not isinstance(c, (Ewm, Roll))}
            out = out.withColumns(plain) if plain else out
            if n < upto:
                out = with_scans(out, {k: c for k, c in levels[n].items() if isinstance(c, (Ewm, Roll))})
        return out

    carry = None
    several = F.col("_total") > block_rows(max(halo, ahead), layout)
    for n in sorted(levels):
        means = {k: c for k, c in levels[n].items() if isinstance(c, Ewm)}
        if means:  # only series of several blocks hand anything over
            long = computed(indexed(several if only is None else only & several), carry, n)
            found = written(block_carry(long, means))
            carry = found if carry is None else carry.join(found, [*SERIES, "_blk"])
    out = computed(indexed(only), carry)
    outputs = list(dict.fromkeys(o for i in indicators for o in i.outputs if o not in base))
    return own(out.select(*base, *outputs, *keep, "_own", "_blk", "_sub"))


# -- indicator definitions ---------------------------------------------------------------------


def _nz(c: Column) -> Column:
    return F.nullif(c, F.lit(0.0))


def _prev(c: str = "close", k: int = 1) -> Column:
    return F.lag(c, k).over(over_block())


def returns_def() -> Indicator:
    return Indicator(
        ("return_pct", "log_return"),
        {
            0: {"_prev_close": _prev()},
            1: {
                "return_pct": (F.try_divide(F.col("close"), F.col("_prev_close")) - 1) * 100,
                "log_return": F.ln(F.try_divide(F.col("close"), F.col("_prev_close"))),
            },
        },
        1,
    )


def moving_averages_def(windows=(7, 25, 99)) -> Indicator:
    return Indicator(
        tuple(f"ma_{n}" for n in windows), {2: {f"ma_{n}": Roll("mean", "close", n) for n in windows}}
    )


def ema_def(spans=(12, 26)) -> Indicator:
    return Indicator(tuple(f"ema_{s}" for s in spans), {2: {f"ema_{s}": Ewm.span("close", s) for s in spans}})


def macd_def() -> Indicator:
    return Indicator(
        ("macd", "macd_signal", "macd_hist"),
        {
            **ema_def().levels,
            3: {"macd": F.col("ema_12") - F.col("ema_26")},
            4: {"macd_signal": Ewm.span("macd", 9)},
            5: {"macd_hist": F.col("macd") - F.col("macd_signal")},
        },
    )


def _moves() -> dict[int, dict]:
    up = F.col("close") - F.col("_prev_close")
    return {
        0: {"_prev_close": _prev()},
        1: {
            "_gain": F.when(up > 0, up).otherwise(0.0),
            "_loss": F.when(up < 0, -up).otherwise(0.0),
        },
    }


def rsi_wilder_def() -> Indicator:
    """Wilder RSI; null while no loss has occurred."""
    rs = F.try_divide(F.col("_avg_gain"), _nz(F.col("_avg_loss")))
    return Indicator(
        ("rsi_14",),
        {
            **_moves(),
            2: {"_avg_gain": Ewm.com("_gain", 13), "_avg_loss": Ewm.com("_loss", 13)},
            3: {"rsi_14": 100 - 100 / (1 + rs)},
        },
        1,
    )


def rsi_simple_def(n: int = 14) -> Indicator:
    """RSI from plain rolling means; the first row has no move, so n + 1 rows are needed."""
    up = F.col("close") - F.col("_prev_close")
    return Indicator(
        ("rsi_14",),
        {
            0: {"_prev_close": _prev()},
            1: {"_up": F.greatest(up, F.lit(0.0) * up), "_down": F.greatest(-up, F.lit(0.0) * up)},
            2: {"_mean_up": Roll("mean", "_up", n), "_mean_down": Roll("mean", "_down", n)},
            3: {"rsi_14": 100 - 100 / (1 + F.col("_mean_up") / (F.col("_mean_down") + EPS))},
        },
        1,
    )


def bollinger_def(n: int = 20, k: float = 2.0, eps: float = 0.0) -> Indicator:
    width = F.col("bb_upper") - F.col("bb_lower")
    if eps:
        rel, pos = width / (F.col("bb_mid") + eps), (F.col("close") - F.col("bb_lower")) / (width + eps)
    else:
        rel = F.try_divide(width, F.col("bb_mid"))
        pos = F.try_divide(F.col("close") - F.col("bb_lower"), _nz(width))
    return Indicator(
        ("bb_mid", "bb_upper", "bb_lower", "bb_width", "bb_pct"),
        {
            2: {"bb_mid": Roll("mean", "close", n), "_bb_std": Roll("std", "close", n)},
            3: {
                "bb_upper": F.col("bb_mid") + k * F.col("_bb_std"),
                "bb_lower": F.col("bb_mid") - k * F.col("_bb_std"),
            },
            4: {"bb_width": rel, "bb_pct": pos},
        },
    )


def true_range_def() -> Indicator:
    return Indicator(
        ("true_range",),
        {
            0: {"_prev_close": _prev()},
            1: {
                "true_range": F.greatest(
                    F.col("high") - F.col("low"),
                    F.abs(F.col("high") - F.col("_prev_close")),
                    F.abs(F.col("low") - F.col("_prev_close")),
                )
            },
        },
        1,
    )


def atr_wilder_def() -> Indicator:
    return Indicator(("atr_14",), {**true_range_def().levels, 2: {"atr_14": Ewm.com("true_range", 13)}}, 1)


def atr_simple_def(n: int = 14) -> Indicator:
    return Indicator(("atr_14",), {**true_range_def().levels, 2: {"atr_14": Roll("mean", "true_range", n)}}, 1)


def volume_def(n: int = 20, eps: float = 0.0) -> Indicator:
    mean = F.col("volume_ma_20")
    ratio = F.col("volume") / (mean + eps) if eps else F.try_divide(F.col("volume"), _nz(mean))
    return Indicator(
        ("volume_ma_20", "volume_ratio"), {2: {"volume_ma_20": Roll("mean", "volume", n)}, 3: {"volume_ratio": ratio}}
    )


def rolling_vol_def(n: int = 30, annualise: bool = True) -> Indicator:
    scale = F.sqrt(lookup(PERIODS_PER_YEAR, "timeframe", DEFAULT_PERIODS)) if annualise else F.lit(1.0)
    source = "log_return" if annualise else "return_pct"
    return Indicator(
        ("rolling_vol_30",),
        {
            **returns_def().levels,
            2: {"_vol": Roll("std", source, n)},
            3: {"rolling_vol_30": F.col("_vol") * scale},
        },
        1,
    )


def price_zscore_def(n: int = 60, eps: float = 0.0) -> Indicator:
    diff, std = F.col("close") - F.col(f"_mean_{n}"), F.col(f"_std_{n}")
    return Indicator(
        ("price_zscore",),
        {
            2: {f"_mean_{n}": Roll("mean", "close", n), f"_std_{n}": Roll("std", "close", n)},
            3: {"price_zscore": diff / (std + eps) if eps else F.try_divide(diff, _nz(std))},
        },
    )


def drawdown_def(eps: float = 0.0) -> Indicator:
    top = F.col("_peak")
    dd = (F.col("close") - top) / (top + eps) if eps else F.try_divide(F.col("close") - top, top)
    return Indicator(("drawdown_pct",), {1: {"drawdown_pct": dd * 100}}, 0, {"_peak": Running("max", F.col("close"))})


def trend_regime_def() -> Indicator:
    a, b, c = (F.col(f"ma_{n}") for n in (7, 25, 99))
    regime = F.when((a > b) & (b > c), "Bull").when((a < b) & (b < c), "Bear").otherwise("Sideways")
    return Indicator(("regime",), {**moving_averages_def().levels, 3: {"regime": regime}})


# -- operators ----------------------------------------------------------------------------------


def _single(make):
    def operator(df: DataFrame, layout: Layout = DEFAULT, **params) -> DataFrame:
        return with_indicators(df, [make(**params)], layout)

    operator.__doc__ = make.__doc__
    return operator


returns = _single(returns_def)
moving_averages = _single(moving_averages_def)
ema = _single(ema_def)
macd = _single(macd_def)
rsi_wilder = _single(rsi_wilder_def)
rsi_simple = _single(rsi_simple_def)
bollinger = _single(bollinger_def)
true_range = _single(true_range_def)
atr_wilder = _single(atr_wilder_def)
atr_simple = _single(atr_simple_def)
volume_features = _single(volume_def)
rolling_vol = _single(rolling_vol_def)
price_zscore = _single(price_zscore_def)
trend_regime = _single(trend_regime_def)


def drawdown(df: DataFrame, layout: Layout = DEFAULT, eps: float = 0.0) -> DataFrame:
    """Distance from the running maximum in percent. Needs no row blocks, only the running maximum."""
    spec = drawdown_def(eps)
    out = index_series(df, spec.running, layout=layout).withColumns(spec.levels[1])
    return drop_index(out).drop("_peak")


def atr_thresholds(measured: DataFrame) -> DataFrame:
    """33 % and 66 % quantile of the Wilder ATR (column ``atr_14``) per series of a stored table."""
    return exact_quantiles(measured, SERIES, "atr_14", {"_q33": 0.33, "_q66": 0.66}, stored=True).drop("n")


def with_regime(measured: DataFrame) -> DataFrame:
    """Low/Mid/High for a stored table with ``atr_14``; the thresholds read that column three times more."""
    atr = F.col("atr_14")
    label = F.when(atr >= F.col("_q66"), "High").when(atr <= F.col("_q33"), "Low").otherwise("Mid")
    labelled = measured.join(atr_thresholds(measured), list(SERIES), "left").withColumn("vol_regime", label)
    return labelled.select(*measured.columns, "vol_regime")


def vol_regime(df: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Low/Mid/High by the 33 % and 66 % quantile of ``atr_14`` over the whole series."""
    return with_regime(written(with_indicators(df, [atr_wilder_def()], layout)))


def calendar_parts(df: DataFrame) -> DataFrame:
    """Weekday (Monday = 0), hour, month, year, day of month and day of year, in UTC."""
    t = F.col(TIME)
    return df.withColumns(
        {
            "day_of_week": F.weekday(t),
            "hour": F.hour(t),
            "month": F.month(t),
            "year": F.year(t),
            "day_of_month": F.dayofmonth(t),
            "day_of_year": F.dayofyear(t),
        }
    )


# Calendar column, period, prefix of the output, offset of the first value.
CYCLES = (
    ("hour", 24, "hour", 0),
    ("day_of_week", 7, "dow", 0),
    ("month", 12, "month", 1),
    ("day_of_month", 31, "dom", 1),
    ("day_of_year", 365.25, "doy", 1),
)
SERVE_CYCLES = (
    ("hour", 24, "hour", 0),
    ("day_of_week", 7, "dow", 0),
    ("month", 12, "month", 0),
    ("day_of_year", 365, "doy", 0),
)


def encode_cyclical(df: DataFrame, cycles=CYCLES) -> DataFrame:
    """Sine and cosine of each calendar part on its period."""
    cols = {}
    for source, period, prefix, first in cycles:
        angle = (F.col(source) - first) * (2 * math.pi) / F.lit(float(period))
        cols[f"{prefix}_sin"] = F.sin(angle)
        cols[f"{prefix}_cos"] = F.cos(angle)
    return df.withColumns(cols)


def drop_warmup(df: DataFrame) -> DataFrame:
    """Remove rows without RSI, MACD or Bollinger middle."""
    return df.dropna(subset=list(CORE))


# Output columns, in order.
FEATURES = (
    "return_pct", "log_return", "ma_7", "ma_25", "ma_99", "ema_12", "ema_26", "macd", "macd_signal", "macd_hist",
    "rsi_14", "bb_mid", "bb_upper", "bb_lower", "bb_width", "bb_pct", "atr_14", "volume_ma_20", "volume_ratio",
    "rolling_vol_30", "price_zscore", "drawdown_pct", "regime", "vol_regime",
    "day_of_week", "hour", "month", "year", "day_of_month", "day_of_year",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "dom_sin", "dom_cos", "doy_sin", "doy_cos",
)


def train_indicators() -> list[Indicator]:
    return [
        returns_def(),
        moving_averages_def(),
        ema_def(),
        macd_def(),
        rsi_wilder_def(),
        bollinger_def(),
        atr_wilder_def(),
        volume_def(),
        rolling_vol_def(),
        price_zscore_def(),
        drawdown_def(),
        trend_regime_def(),
    ]


def engineer_features(df: DataFrame, drop_warmup_rows: bool = True, layout: Layout = DEFAULT) -> DataFrame:
    """The full training feature set: 40 columns after the candle.

    The volatility thresholds use all rows of a series, warm-up rows included. The indicators are
    computed once and written to the shared folder; the thresholds read two of their columns there.
    """
    require(df, REQUIRED_INPUT)
    out = with_regime(written(with_indicators(df.select(*SERIES, TIME, *OHLCV), train_indicators(), layout)))
    out = encode_cyclical(calendar_parts(out))
    if drop_warmup_rows:
        out = drop_warmup(out)
    return out.select(*SERIES, TIME, *OHLCV, *FEATURES)


REQUIRED_INPUT = (TIME, *OHLCV)

# Fixed values.
DASHBOARD_FEATURES = (
    "return_pct", "log_return", "ma_7", "ma_25", "ema_12", "ema_26", "bb_upper", "bb_lower", "bb_mid", "bb_pct",
    "bb_width", "rsi_14", "macd", "macd_signal", "macd_hist", "atr_14", "volume_ratio", "rolling_vol_30",
    "price_zscore", "drawdown_pct",
)


def rolling_indicators() -> list[Indicator]:
    """Indicators of the dashboard and serving profiles: plain rolling RSI and ATR, guarded divisions."""
    return [
        returns_def(),
        moving_averages_def((7, 25)),
        ema_def(),
        bollinger_def(eps=EPS),
        rsi_simple_def(),
        macd_def(),
        atr_simple_def(),
        volume_def(eps=EPS),
        rolling_vol_def(annualise=False),
        price_zscore_def(30, EPS),
        drawdown_def(EPS),
    ]


def features_dashboard(df: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Dashboard profile; missing values are filled forward and then with 0."""
    out = with_indicators(df.select(*SERIES, TIME, *OHLCV), rolling_indicators(), layout)
    return ffill_zero(out, list(DASHBOARD_FEATURES), layout).select(*SERIES, TIME, *OHLCV, *DASHBOARD_FEATURES)


# Fixed values.
SERVE_GROUPS = {
    # column that decides -> columns written when it is missing or null in every row of a series
    "return_pct": ("return_pct",),
    "log_return": ("log_return",),
    "ma_7": ("ma_7",),
    "ma_25": ("ma_25",),
    "ema_12": ("ema_12",),
    "ema_26": ("ema_26",),
    "hour_sin": ("hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "doy_sin", "doy_cos"),
    "volume_ratio": ("volume_ratio",),
    "rsi_14": ("rsi_14",),
    "macd_hist": ("macd", "macd_signal", "macd_hist"),
    "atr_14": ("atr_14",),
    "bb_pct": ("bb_pct", "bb_width"),
    "rolling_vol_30": ("rolling_vol_30",),
    "price_zscore": ("price_zscore",),
    "drawdown_pct": ("drawdown_pct",),
}


def features_serve(df: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Serving profile: computes only what the request lacks, then fills forward and with 0.

    A column counts as lacking when it is absent, or null in all rows of its series.
    """
    given = [c for c in df.columns if c not in (*SERIES, TIME, *OHLCV)]
    candles = df.select(*SERIES, TIME, *OHLCV)
    computed = with_indicators(candles, rolling_indicators(), layout)
    computed = encode_cyclical(calendar_parts(computed), SERVE_CYCLES)
    wanted = [c for cols in SERVE_GROUPS.values() for c in cols]
    computed = computed.select(*SERIES, TIME, *OHLCV, *wanted)
    kept = [c for c in given if c in wanted]
    if not given:
        return computed.fillna(0.0, wanted)
    flags = df.groupBy(*SERIES).agg(*[F.count(c).alias(f"_has_{c}") for c in SERVE_GROUPS if c in given], F.count(F.lit(1)).alias("_rows"))
    extra = df.select(*SERIES, TIME, *[F.col(c).alias(f"_in_{c}") for c in given])
    out = computed.join(extra, [*SERIES, TIME]).join(flags, list(SERIES))
    cols = {}
    for decider, group in SERVE_GROUPS.items():
        has = F.col(f"_has_{decider}") > 0 if decider in given else F.lit(False)
        for c in group:
            cols[c] = F.when(has, F.col(f"_in_{c}")).otherwise(F.col(c)) if c in given else F.when(~has, F.col(c))
    others = [c for c in given if c not in wanted]
    out = out.select(*SERIES, TIME, *OHLCV, *[v.alias(k) for k, v in cols.items()], *[F.col(f"_in_{c}").alias(c) for c in others])
    return ffill_zero(out, [*wanted, *others] if others else wanted, layout)


def ffill_zero(df: DataFrame, columns: list[str], layout: Layout = DEFAULT) -> DataFrame:
    """Fill nulls of each series forward; what is still null becomes 0."""
    running = {f"_f_{c}": Running("ffill", F.col(c)) for c in columns}
    out = drop_index(index_series(df, running, layout=layout))
    zero = {c: F.lit("0") if t == "string" else F.lit(0).cast(t) for c, t in df.dtypes}
    return out.withColumns({c: F.coalesce(F.col(f"_f_{c}"), zero[c]) for c in columns}).drop(*running)
