"""Ordered work over very long series without one task per series.

``partitionBy(symbol, timeframe)`` puts a whole series into one task, so a single series that
holds a large part of the table decides the run time. The helpers here split every series:

* ``index_series`` numbers the rows of a series (``_rn`` from 0, ``_total`` rows) and computes
  running aggregates. Rows are shuffled by ``(series, time bucket)``. One summary row per bucket
  is scanned over the series and joined back as the carry into the bucket.
* ``row_blocks`` cuts the numbered series into blocks of equal row count and copies the last
  ``halo`` rows of a block into the next one, so that every window frame of at most ``halo``
  preceding rows is complete inside a block. Copies are marked ``_own = false``.

Results equal those of a window over the whole series; nothing is cut off at block borders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickframe.schema import SERIES, TIME, step_ms

SUB = 512  # rows of a sub-block; row blocks start at multiples of it


@dataclass(frozen=True)
class Layout:
    """Bucket length in candles of the timeframe, and block length in rows."""

    span: int = 65_536
    rows: int = 30 * SUB


DEFAULT = Layout()
HELPERS = ("_tb", "_rn", "_total", "_blk", "_sub", "_own")


@dataclass(frozen=True)
class Running:
    """A running aggregate of ``value`` over a series.

    kind: ``sum``, ``max``, ``min`` (including the row), ``first`` (first row's value), ``prev`` (value of the row
    before), ``ffill`` (last non-null value including the row).
    """

    kind: str
    value: Column


def time_bucket(span: int, keys=SERIES, time=TIME) -> Column:
    day = 86_400_000
    step = F.coalesce(step_ms(), F.lit(day)) if "timeframe" in keys else F.lit(day)
    return F.floor(F.unix_millis(F.col(time).cast("timestamp")) / (step * span))


def _summary(kind: str, value: Column, time: str) -> Column:
    at = F.col(time)
    return {
        "sum": lambda: F.sum(value),
        "max": lambda: F.max(value),
        "min": lambda: F.min(value),
        "first": lambda: F.min_by(value, at),
        "prev": lambda: F.max_by(value, at),
        "ffill": lambda: F.max_by(value, F.when(value.isNotNull(), at)),
    }[kind]()


def _carry(kind: str, c: str, before) -> Column:
    x = F.col(c)
    fn = {
        "sum": lambda: F.sum(x),
        "max": lambda: F.max(x),
        "min": lambda: F.min(x),
        "first": lambda: F.first(x),
        "prev": lambda: F.last(x),
        "ffill": lambda: F.last(x, ignorenulls=True),
    }[kind]()
    return fn.over(before)


def _running(kind: str, value: Column, carry: Column, w) -> Column:
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if kind == "sum":
        return F.coalesce(carry, F.lit(0.0)) + F.coalesce(F.sum(value).over(upto), F.lit(0.0))
    if kind == "max":
        return F.greatest(carry, F.max(value).over(upto))
    if kind == "min":
        return F.least(carry, F.min(value).over(upto))
    if kind == "first":
        return F.coalesce(carry, F.first(value).over(upto))
    if kind == "prev":
        return F.when(F.row_number().over(w) == 1, carry).otherwise(F.lag(value).over(w))
    return F.coalesce(F.last(value, ignorenulls=True).over(upto), carry)


def index_series(
    df: DataFrame,
    running: dict[str, Running] | None = None,
    *,
    keys=SERIES,
    time: str = TIME,
    layout: Layout = DEFAULT,
    attributes: DataFrame | None = None,
    only: Column | None = None,
) -> DataFrame:
    """Add ``_rn`` (0-based row number per series), ``_total`` and running aggregates.

    One shuffle of the rows. The summary has one row per ``layout.span`` candles, so the window
    over a whole series runs on 1/65,536 of its rows with the default layout. ``attributes`` (one
    row per series) and ``only`` (a condition on ``_total`` and the attributes) are applied to the
    summary, so they reach the rows with the same join.
    """
    running = running or {}
    keys = list(keys)
    src = df.drop("_rn", "_total").withColumn("_tb", time_bucket(layout.span, keys, time))
    part = src.groupBy(*keys, "_tb").agg(
        F.count(F.lit(1)).alias("_cnt"),
        *[_summary(r.kind, r.value, time).alias(f"_s_{n}") for n, r in running.items()],
    )
    before = Window.partitionBy(*keys).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    carry = part.select(
        *keys,
        "_tb",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(*keys)).alias("_total"),
        *[_carry(r.kind, f"_s_{n}", before).alias(f"_s_{n}") for n, r in running.items()],
    )
    if attributes is not None:
        carry = carry.join(attributes, keys, "left")
    if only is not None:
        carry = carry.filter(only)
    w = Window.partitionBy(*keys, "_tb").orderBy(time)
    out = src.join(carry, [*keys, "_tb"]).withColumns(
        {
            "_rn": F.row_number().over(w) - 1 + F.col("_off"),
            **{n: _running(r.kind, r.value, F.col(f"_s_{n}"), w) for n, r in running.items()},
        }
    )
    return out.drop("_tb", "_off", *[f"_s_{n}" for n in running])


def row_blocks(df: DataFrame, halo: int, layout: Layout = DEFAULT, ahead: int = 0) -> DataFrame:
    """Split an indexed series into row blocks, each with the ``halo`` rows before and ``ahead`` rows after it.

    Adds ``_blk``, ``_sub`` (global sub-block number) and ``_own``. Use ``over_block()`` for
    windows and ``own`` to drop the copied rows afterwards.
    """
    rows = block_rows(max(halo, ahead), layout)
    home = F.floor(F.col("_rn") / rows)
    out = df.withColumn("_sub", F.floor(F.col("_rn") / SUB))
    if halo <= 0 and ahead <= 0:
        return out.withColumns({"_blk": home, "_own": F.lit(True)})
    is_tail = (F.pmod(F.col("_rn"), F.lit(rows)) >= rows - halo) & ((home + 1) * rows < F.col("_total"))
    targets = F.when(is_tail, F.array(home, home + 1)).otherwise(F.array(home))
    if ahead > 0:
        is_head = (F.pmod(F.col("_rn"), F.lit(rows)) < ahead) & (home > 0)
        targets = F.when(is_head, F.concat(targets, F.array(home - 1))).otherwise(targets)
    out = out.withColumn("_blk", F.explode(targets))
    return out.withColumn("_own", F.col("_blk") == home)


def block_rows(halo: int, layout: Layout = DEFAULT) -> int:
    rows = max(layout.rows, 2 * halo)
    return -(-rows // SUB) * SUB


def over_block(keys=SERIES):
    """Window spec of a row block, in series order."""
    return Window.partitionBy(*keys, "_blk").orderBy("_sub", "_rn")


def over_sub(keys=SERIES):
    """Window spec of a sub-block; same sort order as ``over_block``."""
    return Window.partitionBy(*keys, "_blk", "_sub").orderBy("_rn")


def own(df: DataFrame) -> DataFrame:
    return df.filter("_own").drop("_own", "_blk", "_sub")


def drop_index(df: DataFrame) -> DataFrame:
    return df.drop(*HELPERS)


def rolling(n: int, keys=SERIES):
    return over_block(keys).rowsBetween(-(n - 1), Window.currentRow)


def rolled(fn, c, n: int, min_periods: int | None = None, keys=SERIES) -> Column:
    """``fn(c)`` over the last ``n`` rows, null until ``min_periods`` (default n) values are present."""
    x = F.col(c) if isinstance(c, str) else c
    w = rolling(n, keys)
    return F.when(F.count(x).over(w) >= (n if min_periods is None else min_periods), fn(x).over(w))


def top_per_series(df: DataFrame, n: int, order: list, keys=SERIES, salts: int = 64) -> DataFrame:
    """First ``n`` rows per series under ``order``, in two steps.

    The first step ranks inside 64 slices of a series, so the last step sees at most ``64 * n``
    rows of any series, whatever its length.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(TIME), F.lit(salts)))
    first = (
        salted.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)))
        .filter(F.col("_r") <= n)
        .drop("_r", "_salt")
    )
    return first.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(
        F.col("_r") <= n
    )
