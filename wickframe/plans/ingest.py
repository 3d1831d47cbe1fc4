"""Composite steps from raw candles to the stored table and the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wickframe.operators.blocks import DEFAULT, Layout
from wickframe.operators.clean import clean_candles, cleaning_report
from wickframe.operators.features import engineer_features


def clean_and_engineer(
    df: DataFrame, drop_warmup_rows: bool = True, layout: Layout = DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """Feature table of the cleaned candles, and the cleaning report."""
    features = engineer_features(clean_candles(df), drop_warmup_rows, layout)
    return features, cleaning_report(df, layout=layout)
