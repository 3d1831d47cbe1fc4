"""Streams whose state enters as rows, against the batch operators over all rows at once."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import candle_rows
from wickframe.operators import features as f
from wickframe.operators.blocks import Layout
from wickframe.streaming import carried

SMALL = Layout(span=100, rows=512)


def run(spark, tmp_path, parts, step):
    """Every part is written and processed by a run of its own, as after a restart."""
    for part in parts:
        spark.createDataFrame(part.sample(frac=1, random_state=1)).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
        carried.run_carried(stream, step, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp"))
    return spark.read.parquet(str(tmp_path / "out"))


@pytest.fixture(scope="module")
def two_series():
    a, b = candle_rows(2600, "A", "1h", seed=7), candle_rows(130, "B", "1h", seed=8)
    return a, b


def test_indicators_over_several_blocks_and_batches(spark, tmp_path, two_series):
    a, b = two_series
    parts = [pd.concat([a[:1500], b[:40]]), a[1500:1501], pd.concat([a[1501:], b[40:]])]
    got = run(spark, tmp_path, parts, carried.indicators_step(SMALL)).toPandas().sort_values(["symbol", "open_time"])
    defs = [f.macd_def(), f.ema_def(), f.rsi_wilder_def(), f.atr_wilder_def(), f.drawdown_def()]
    want = f.with_indicators(spark.createDataFrame(pd.concat([a, b])), defs).toPandas().sort_values(["symbol", "open_time"])
    assert len(got) == len(want) and not got["late"].any()
    for col in carried.INDICATORS:
        np.testing.assert_allclose(got[col].astype(float), want[col].astype(float), rtol=1e-9, atol=1e-9, err_msg=col)


def test_anomalies_over_several_blocks_and_batches(spark, tmp_path, two_series):
    a, b = two_series
    step = carried.anomaly_step(layout=SMALL)
    got = run(spark, tmp_path, [pd.concat([a[:700], b[:30]]), pd.concat([a[700:720], b[30:50]]), pd.concat([a[720:], b[50:]])], step)
    got = got.toPandas().sort_values(["symbol", "open_time"])
    want = pd.concat([x.sort_values("open_time") for x in two_series])
    groups = want.groupby("symbol")
    std = groups["close"].transform(lambda c: c.rolling(60).std().replace(0.0, np.nan))
    z = (want["close"] - groups["close"].transform(lambda c: c.rolling(60).mean())) / std
    ratio = want["volume"] / groups["volume"].transform(lambda v: v.rolling(20).mean().replace(0.0, np.nan))
    np.testing.assert_allclose(got["price_zscore"].astype(float), z, rtol=1e-7, atol=1e-9)
    np.testing.assert_allclose(got["volume_ratio"].astype(float), ratio, rtol=1e-9)


def test_gaps_across_batches(spark, tmp_path, two_series):
    a = two_series[0]
    found = carried.gaps(run(spark, tmp_path, [a[:300], a[310:600], a[602:]], carried.gaps_step(SMALL))).orderBy("gap_end").collect()
    assert [r.missing for r in found] == [10, 2]
    assert [r.gap_start for r in found] == [a["open_time"].iloc[299], a["open_time"].iloc[601 - 2]]


def test_late_copied_and_odd_rows(spark, tmp_path, two_series):
    a = two_series[0]
    odd = a[20:22].assign(symbol=[None, "A"])
    odd["open_time"] = [odd["open_time"].iloc[0], pd.NaT]
    parts = [a[:10], pd.concat([a[20:50], a[30:33], odd]), a[12:15], a[:0]]
    got = run(spark, tmp_path, parts[:3], carried.indicators_step(SMALL))
    assert got.count() == 10 + 30 + 3 + 2 + 3 and got.filter("late").count() == 3 + 2 + 3
    good = f.with_indicators(spark.createDataFrame(pd.concat([a[:10], a[20:50]])), [f.ema_def()]).agg(F.sum("ema_12")).first()[0]
    assert got.filter("not late").agg(F.sum("ema_12")).first()[0] == pytest.approx(good, rel=1e-12)


def test_a_repeated_batch_writes_the_same(spark, tmp_path, two_series):
    a = two_series[0]
    write = carried.carried(carried.indicators_step(SMALL), str(tmp_path / "out"), str(tmp_path / "state"))
    first, second = spark.createDataFrame(a[:50]), spark.createDataFrame(a[50:90])
    write(first, 0)
    write(second, 1)
    before = spark.read.parquet(str(tmp_path / "out")).orderBy("open_time").collect()
    write(second, 1)
    assert spark.read.parquet(str(tmp_path / "out")).orderBy("open_time").collect() == before and len(before) == 90
    write(first.limit(0), 2)
    assert spark.read.parquet(str(tmp_path / "state/2")).collect() == spark.read.parquet(str(tmp_path / "state/1")).collect()
