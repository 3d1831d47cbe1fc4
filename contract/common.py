"""Shared pieces of the registered queries and of their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Day-, hour- and minute-bars as SQL; the Spark side builds the same with ``sources.adapters``.
EVENT_BARS = """
 select event_type as symbol, '{tf}' as timeframe, date_trunc('{unit}', ts) as open_time,
        first(value order by ts, event_id) as open, max(value) as high, min(value) as low,
        last(value order by ts, event_id) as close, count(*)::double as volume
 from events group by 1, 2, 3"""
BARS_1H = EVENT_BARS.format(tf="1h", unit="hour")
BARS_1M = EVENT_BARS.format(tf="1m", unit="minute")
BARS_1D = """
 select o_orderpriority as symbol, '1d' as timeframe, date_trunc('day', o_orderdate) as open_time,
        first(o_totalprice order by o_orderkey) as open, max(o_totalprice) as high, min(o_totalprice) as low,
        last(o_totalprice order by o_orderkey) as close, count(*)::double as volume
 from orders group by 1, 2, 3"""
BARS_SUPP = """
 select l_suppkey::varchar as symbol, '1d' as timeframe, date_trunc('day', l_shipdate) as open_time,
        first(l_extendedprice order by l_orderkey, l_linenumber, l_extendedprice) as open,
        max(l_extendedprice) as high, min(l_extendedprice) as low,
        last(l_extendedprice order by l_orderkey, l_linenumber, l_extendedprice) as close,
        sum(l_quantity)::double as volume
 from lineitem group by 1, 2, 3"""
GOOD = "open > 0 and high > 0 and low > 0 and close > 0"  # what cleaning leaves of the bars
W = "(partition by symbol, timeframe order by open_time)"
S = "(partition by symbol, timeframe)"


def frame(n: int) -> str:
    return f"(partition by symbol, timeframe order by open_time rows between {n - 1} preceding and current row)"


def rolled(fn: str, x: str, n: int, least: int | None = None) -> str:
    least = n if least is None else least
    return f"case when count({x}) over {frame(n)} >= {least} then {fn}({x}) over {frame(n)} end"


def rsql(cols: dict[str, str] | list[str], digits: int = 6) -> str:
    """Select list that rounds every expression."""
    items = cols.items() if isinstance(cols, dict) else [(c, c) for c in cols]
    return ", ".join(f"round({x}, {digits}) as {n}" for n, x in items)


def out(df: DataFrame, digits: int = 6) -> DataFrame:
    """Plain output types: timestamps without zone, bigint, rounded double."""
    cols = []
    for name, t in df.dtypes:
        c = F.col(name)
        if t == "timestamp":
            c = c.cast("timestamp_ntz")
        elif t in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif t in ("double", "float"):
            c = F.round(c.cast("double"), digits)
        elif t.startswith("decimal"):
            c = F.round(c.cast("double"), digits)
        cols.append(c.alias(name))
    return df.select(*cols)
