"""wickframe: candle-series analytics on Spark DataFrames.

Every operator is a lazy function ``f(df, ...) -> DataFrame`` over a table that holds many
``(symbol, timeframe)`` series, one row per series and ``open_time``.
"""
