"""Weighted and rolling moments over the sorted rows of row blocks, batch by batch in NumPy.

``Ewm`` is pandas' ``ewm(adjust=False).mean()``: a value x that follows the last value d rows before gives
y = (q^d * y_before + a*x) / (q^d + a) with q = 1 - a, and a null keeps y. So every row is an affine map of the mean before it, and maps
are joined by doubling: 1, 2, 4, .. rows. No weight is ever divided by, so any 0 < a <= 1 works. Blocks are
joined the same way: one row per block of a series that has several (first value, decay and offset from there on, rows since the last value)
is scanned over the series, and the mean before each block is joined to its rows. No rows are copied for it.

``Roll``, mean or sample deviation of the last n rows: the moments of 1, 4, 16, 64, .. rows are built by joining four quarters,
and the window is put together from those pieces, so the work grows with log n. Pieces are only ever added, never subtracted,
so a past outlier leaves no rounding error behind and a window of equal values has a deviation of exactly 0.

Rows that a block copies from its neighbours serve rolling windows; their weighted means are null. NaN counts as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickframe.schema import SERIES

BUFFER = 1 << 16  # rows after which complete blocks are computed


@dataclass(frozen=True)
class Ewm:
    """Exponentially weighted mean of a column, as pandas computes it with ``adjust=False``."""

    column: str
    alpha: float

    def __post_init__(self):
        if not 0.0 < self.alpha <= 1.0:
            raise ValueError("alpha must lie above 0 and at most at 1")

    @classmethod
    def span(cls, column: str, span: float) -> "Ewm":
        return cls(column, 2.0 / (span + 1.0))

    @classmethod
    def com(cls, column: str, com: float) -> "Ewm":
        return cls(column, 1.0 / (1.0 + com))

    @property
    def halo(self) -> int:
        return 0

    def after(self, before: np.ndarray, distance: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The mean at a value, from the mean at the value ``distance`` rows before."""
        return x + (before - x) * self.weights(distance)[0]

    def weights(self, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the mean before and of a value that many rows after the last one."""
        faded = np.power(1.0 - self.alpha, distance)
        whole = np.where(distance == 1, 1.0, faded + self.alpha)
        return faded / whole, self.alpha / whole


@dataclass(frozen=True)
class Roll:
    """``mean`` or ``std`` of the last ``n`` rows; null while one of them is missing or null."""

    fn: str
    column: str
    n: int

    @property
    def halo(self) -> int:
        return self.n

    @property
    def top(self) -> int:
        """Level of the largest piece."""
        level = 0
        while 4 ** (level + 1) <= self.n:
            level += 1
        return level

    def pieces(self) -> list[tuple[int, int]]:
        """(level, offset) of the pieces of 4^level rows, the newest first."""
        out, offset = [], 0
        for level in range(self.top, -1, -1):
            while self.n - offset >= 4**level:
                out.append((level, offset))
                offset += 4**level
        return out


def arranged(df: DataFrame, keys=SERIES, carry: DataFrame | None = None) -> DataFrame:
    """A blocked frame with every block in one partition and in order; ``carry`` adds columns per block."""
    out = df.repartition(*keys, "_blk")
    if carry is not None:
        out = out.join(carry, [*keys, "_blk"], "left")
    return out.sortWithinPartitions(*keys, "_blk", "_sub", "_rn")


# -- NumPy side ---------------------------------------------------------------------------------


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    out = np.full(len(x), np.nan)
    out[by:] = x[: max(len(x) - by, 0)]
    return out if by else x


class _Moments:
    """Moments of pieces of one column, level by level: mean, and sum of squares around it."""

    def __init__(self, x: np.ndarray):
        self.levels = [(x, np.zeros(len(x)))]

    def at(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.levels) <= level:
            size = 4 ** (len(self.levels) - 1)
            m, q = self.levels[-1]
            d = [_shifted(m, j * size) - m for j in (1, 2, 3)]
            total = d[0] + d[1] + d[2]
            spread = d[0] * d[0] + d[1] * d[1] + d[2] * d[2] - total * total / 4
            self.levels.append((m + total / 4, q + sum(_shifted(q, j * size) for j in (1, 2, 3)) + spread * size))
        return self.levels[level]

    def roll(self, r: Roll) -> np.ndarray:
        (top, first_at), *rest = r.pieces()
        base = _shifted(self.at(top)[0], first_at)
        parts = [(4**k, _shifted(self.at(k)[0], o) - base) for k, o in rest]
        first = sum((d * size for size, d in parts), np.zeros(len(base)))
        if r.fn == "mean":
            return base + first / r.n
        inner = sum((_shifted(self.at(k)[1], o) for k, o in rest), _shifted(self.at(top)[1], first_at))
        second = sum((d * d * size for size, d in parts), np.zeros(len(base)))
        return np.sqrt(np.maximum(inner + second - first * first / r.n, 0.0) / (r.n - 1))


def _chain(decay: np.ndarray, weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Weighted mean of a chain of rows up to each row; chains begin where the decay is 0.

    A stretch of rows is (decay a, weight w, mean m): it turns y into a*y + w*m. Means are only moved towards each
    other by a share of their difference, so the mean of equal values is that value.
    """
    a, w, m = decay.copy(), weight.copy(), mean.copy()
    by = 1
    while by < len(a) and a.any():
        older = a[by:] * w[:-by]
        total = older + w[by:]
        live = older > 0
        share = np.divide(older, total, out=np.zeros(len(older)), where=live)
        m[by:] += np.where(live, np.where(live, m[:-by] - m[by:], 0.0) * share, 0.0)
        w[by:] = total
        a[by:] = a[by:] * a[:-by]
        a[:by] = 0.0
        by *= 2
    return m


class _Blocks:
    """Borders of the blocks in a table of sorted rows."""

    def __init__(self, rn: np.ndarray, blk: np.ndarray, own: np.ndarray):
        n = len(rn)
        # rows of a block follow each other; the next block has another number or starts elsewhere
        fresh = np.append(True, (rn[1:] != rn[:-1] + 1) | (blk[1:] != blk[:-1]))
        self.starts = np.flatnonzero(fresh)
        self.of = np.cumsum(fresh) - 1
        self.place = np.arange(n) - self.starts[self.of]
        self.own = own
        own_at = np.where(own, np.arange(n), n)
        self.first_own = np.minimum.reduceat(own_at, self.starts)
        self.last_own = np.maximum.reduceat(np.where(own, np.arange(n), -1), self.starts)

    def observed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own rows with a value, and for every row the last such row before it in the block, or -1."""
        seen = self.own & ~np.isnan(x)
        last = np.maximum.accumulate(np.where(seen, np.arange(len(x)), -1))
        before = np.append(-1, last[:-1])
        return seen, np.where(before >= self.starts[self.of], before, -1)


def _ewm(e: Ewm, x: np.ndarray, blocks: _Blocks, value: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """``value`` (NaN where there is none) and ``gap`` are the mean and the rows since its last value before the block."""
    n = len(x)
    rows = np.arange(n)
    seen, before = blocks.observed(x)
    begin = blocks.first_own[blocks.of]
    carried = ~np.isnan(value)
    distance = np.where(before >= 0, rows - before, rows - begin + 1 + gap)
    decay, weight = e.weights(np.maximum(distance, 1))
    filled = np.where(seen, x, 0.0)
    opening = seen & (before < 0)
    start = rows == begin
    kept = start & ~seen & carried
    # the first value of a block continues the mean before it, or is the mean
    m = np.where(opening & carried, filled + (np.where(carried, value, filled) - filled) * decay, np.where(kept, value, filled))
    a = np.where(opening | start | ~blocks.own, 0.0, np.where(seen, decay, 1.0))
    w = np.where(opening | kept, 1.0, np.where(seen, weight, 0.0))
    out = _chain(a, w, m)
    known = blocks.own & (seen | (before >= 0) | carried)
    return np.where(known, out, np.nan)


def _doubles(column: pa.ChunkedArray) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False) if column.null_count == 0 else column.cast(pa.float64()).to_pandas().to_numpy(dtype=float, na_value=np.nan)


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of complete blocks, from sorted batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= BUFFER:
            table = pa.Table.from_batches(held)
            rn, blk = (table.column(c).to_numpy() for c in ("_rn", "_blk"))
            cut = int(_Blocks(rn, blk, np.ones(len(rn), bool)).starts[-1])
            if cut:
                yield table.slice(0, cut)
                rest = table.slice(cut).combine_chunks()
                held, size = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _blocks_of(table: pa.Table) -> _Blocks:
    return _Blocks(*(table.column(c).to_numpy() for c in ("_rn", "_blk", "_own")))


def with_scans(df: DataFrame, columns: dict[str, Ewm | Roll]) -> DataFrame:
    """Add the given moments to an arranged frame. ``_v_<name>`` and ``_g_<name>`` hold what ``block_carry`` found, if they are there."""
    if not columns:
        return df
    names = [*df.columns, *columns]
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.DoubleType()) for c in columns]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            blocks = _blocks_of(table)
            values = {c: _doubles(table.column(c)) for c in {s.column for s in columns.values()}}
            moments = {c: _Moments(x) for c, x in values.items()}
            arrays = list(table.columns)
            for name, s in columns.items():
                x = values[s.column]
                if isinstance(s, Roll):
                    y = np.where(blocks.place >= s.n - 1, moments[s.column].roll(s), np.nan)
                elif f"_v_{name}" in table.column_names:
                    gap = np.nan_to_num(_doubles(table.column(f"_g_{name}")))
                    y = _ewm(s, x, blocks, _doubles(table.column(f"_v_{name}")), gap)
                else:
                    y = _ewm(s, x, blocks, np.full(len(x), np.nan), np.zeros(len(x)))
                arrays.append(pa.chunked_array([pa.array(y, mask=np.isnan(y))]))
            yield from pa.Table.from_arrays(arrays, names=names).combine_chunks().to_batches(max_chunksize=10_000)

    return df.mapInArrow(run, schema)


def block_carry(df: DataFrame, columns: dict[str, Ewm], keys=SERIES) -> DataFrame:
    """Per block of an arranged frame the mean before it (``_v_<name>``) and the rows since its last value (``_g_<name>``).

    Tasks reduce every block to one row; the rows of a series, one per block, are scanned together.
    """
    keys = list(keys)
    parts = [T.StructField(f"{p}_{c}", T.DoubleType()) for c in columns for p in ("at", "x", "a", "b", "t")]
    key_fields = [df.schema[c] for c in (*keys, "_blk")]
    summary = T.StructType([*key_fields, *parts])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            blocks = _blocks_of(table)
            rows = np.arange(table.num_rows)
            arrays = [table.column(c).take(pa.array(blocks.starts)).combine_chunks() for c in (*keys, "_blk")]
            last = blocks.last_own
            for e in columns.values():
                x = _doubles(table.column(e.column))
                seen, before = blocks.observed(x)
                decay, weight = e.weights(np.where(before >= 0, rows - before, 1))
                first = seen & (before < 0)
                later = seen & ~first
                a = np.where(before < 0, 0.0, np.where(seen, decay, 1.0))
                mean = _chain(a, np.where(later, weight, 0.0), np.where(later, x, 0.0))
                left = np.multiply.reduceat(np.where(later, decay, 1.0), blocks.starts)
                at = np.minimum.reduceat(np.where(first, rows, table.num_rows), blocks.starts)
                none = at == table.num_rows
                end = np.maximum.reduceat(np.where(seen, rows, -1), blocks.starts)
                opening = np.where(none, 0, at)
                arrays += [
                    pa.array(np.where(none, np.nan, at - blocks.first_own)),
                    pa.array(np.where(none, np.nan, x[opening])),
                    pa.array(left),
                    pa.array(mean[last]),
                    pa.array(np.where(none, last - blocks.first_own + 1, last - end).astype(float)),
                ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keys, "_blk", *[p.name for p in parts]])

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_blk")
        out = pdf[[*keys, "_blk"]].copy()
        for c, e in columns.items():
            value, gap, values, gaps = np.nan, 0.0, [], []
            for at, x, a, b, t in pdf[[f"{p}_{c}" for p in ("at", "x", "a", "b", "t")]].itertuples(index=False):
                values.append(value)
                gaps.append(gap)
                if np.isnan(at):
                    gap += t
                else:
                    opening = x if np.isnan(value) else float(e.after(value, np.float64(gap + at + 1), x))
                    value, gap = b + (opening - b) * a, t
            out[f"_v_{c}"], out[f"_g_{c}"] = values, gaps
        return out

    carry = T.StructType([*key_fields, *[T.StructField(f"{p}_{c}", T.DoubleType()) for c in columns for p in ("_v", "_g")]])
    needed = list(dict.fromkeys([*keys, "_blk", "_rn", "_own", *[e.column for e in columns.values()]]))
    return df.select(*needed).mapInArrow(reduce, summary).groupBy(*keys).applyInPandas(scan, carry)
