import threading
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from conftest import candle_rows
from pyspark.sql import functions as F

from wickframe.operators import cluster as c
from wickframe.operators import features as f
from wickframe.operators import forecast as m
from wickframe.sources import store
from wickframe.streaming import candles as s


def blobs():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 0.3, (80, 4)), rng.normal(4, 0.3, (60, 4)), rng.uniform(-8, 8, (15, 4)), np.zeros((20, 4))])
    pdf = pd.DataFrame(x, columns=list("abcd"))
    pdf.insert(0, "open_time", pd.date_range("2024-01-01", periods=len(x), freq="h"))
    pdf.insert(0, "timeframe", "1h")
    pdf.insert(0, "symbol", "A")
    return pdf, x


def dbscan_brute(x, eps, least=5):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    near, n = d <= eps, len(x)
    core = near.sum(1) >= least
    label = np.full(n, -1)
    k = 0
    for i in range(n):
        if core[i] and label[i] < 0:
            todo = [i]
            while todo:
                j = todo.pop()
                if label[j] < 0:
                    label[j] = k
                    todo += [q for q in np.flatnonzero(near[j] & core) if label[q] < 0]
            k += 1
    for i in range(n):
        if not core[i] and (near[i] & core).any():
            label[i] = label[np.flatnonzero(near[i] & core)].min()
    return label


def test_dbscan_and_knn_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(c, "CHUNK", 7)
    monkeypatch.setattr(c._packed, "__defaults__", (7,))
    pdf, x = blobs()
    df = spark.createDataFrame(pdf)
    got = c.dbscan(df, 0.7).toPandas().sort_values("open_time")["cluster"].to_numpy()
    assert (got == dbscan_brute(x, 0.7)).all()
    knn = c.knn_distance(df).toPandas().sort_values("open_time")["knn"].to_numpy()
    d = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), axis=1)[:, 4]
    np.testing.assert_allclose(knn, d, rtol=1e-9, atol=1e-12)
    eps = c.elbow_eps(c.knn_distance(df)).first().eps
    k = np.sort(d)
    assert eps == pytest.approx(round(max(0.3, min(k[np.argmax(np.diff(k, 2)) + 2], 3.0)), 2))


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame(pd.concat([candle_rows(160, "A", seed=1), candle_rows(140, "B", seed=2)]))
    rows = m.cut(m.split_rows(m.supervised_rows(df), folds=2))
    small = {"gbt": {"maxIter": 2, "maxDepth": 2}, "forest": {"numTrees": 3, "maxDepth": 3}}
    fitted = m.fit_stacking(rows.filter("part = 'train'"), params=small)
    return df, rows, m.calibrate(fitted, rows.filter("part = 'calibration'"))


def test_learners_are_fitted_side_by_side(model, monkeypatch):
    """No fit waits for the end of another one, and the models equal those fitted one after the other."""
    _, rows, fitted = model
    small = {"gbt": {"maxIter": 2, "maxDepth": 2}, "forest": {"numTrees": 3, "maxDepth": 3}}
    train, real, both = rows.filter("part = 'train'"), m._learner, threading.Barrier(2, timeout=60)

    class Waiting:
        def __init__(self, *args):
            self.learner = real(*args)

        def fit(self, x):
            both.wait()
            return self.learner.fit(x)

    x = m._assemble(train, fitted.features)
    alone = [real(n, small[n]).fit(x.filter(f"fold < {k}")).toDebugString for k in (1, 2) for n in m.BASES]
    monkeypatch.setattr(m, "_learner", Waiting)
    again = m.fit_stacking(train, params=small)
    assert [again.bases[n].toDebugString.split("\n")[1:] for n in m.BASES] == [real(n, small[n]).fit(x).toDebugString.split("\n")[1:] for n in m.BASES]
    models = m._fit_learners(x, [(n, k) for k in (1, 2) for n in m.BASES], small)
    assert [models[n, k].toDebugString.split("\n")[1:] for k in (1, 2) for n in m.BASES] == [t.split("\n")[1:] for t in alone]
    assert again.meta.coefficients == fitted.meta.coefficients


def test_model_round_trip(spark, model, tmp_path):
    _, rows, fitted = model
    m.save_model(fitted, str(tmp_path / "m"))
    loaded = m.load_model(spark, str(tmp_path / "m"))
    assert loaded.features == fitted.features and "close" not in loaded.features and "y" not in loaded.features
    test = rows.filter("part = 'test'")
    a, b = (m.predict_batch(x, test).orderBy("symbol", "open_time").toPandas() for x in (fitted, loaded))
    pd.testing.assert_frame_equal(a, b)
    assert (a["lower_90"] <= a["lower_80"]).all() and (a["lower_80"] <= a["y_pred"]).all()


def test_recursive_forecast(model):
    df, _, fitted = model
    for mode in ("reference", "full"):
        out = m.recursive_forecast(fitted, df, 3, mode).toPandas()
        assert sorted(out["step"]) == [1, 1, 2, 2, 3, 3] and np.isfinite(out["y_pred"]).all()
    few = df.filter("open_time < '2023-01-08'")
    assert m.recursive_forecast(fitted, few, 2).count() == 0
    with pytest.raises(ValueError):
        m.recursive_forecast(fitted, df, 31)


def test_recursive_forecast_equals_recomputation(spark, model):
    """Every step's features over the whole history and all predictions so far; series longer than the state reaches."""
    _, _, fitted = model
    pdf = pd.concat([candle_rows(m.TAIL + 700, "A", seed=5), candle_rows(90, "B", seed=6), candle_rows(m.TAIL, "C", seed=7)])
    pdf.loc[(pdf["symbol"] == "B") & (pdf["open_time"] == "2023-03-01"), "close"] = np.nan
    got = m.recursive_forecast(fitted, spark.createDataFrame(pdf), 4, "full").toPandas().set_index(["symbol", "step"])["y_pred"]
    whole = spark.createDataFrame(pdf)
    lags = [x for x in fitted.features if x.startswith("close_")]
    ends = [m.build_lag_features(x, drop_na=False).toPandas().sort_values("open_time").groupby("symbol").tail(1) for x in (whole, store.latest_n(whole, m.TAIL))]
    a, b = (x.sort_values("symbol")[lags].to_numpy(float) for x in ends)
    np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-9)
    now = pdf
    for step in range(1, 5):
        feats = m.build_lag_features(spark.createDataFrame(now), drop_na=False).fillna(0.0, fitted.features)
        newest = now.groupby("symbol")["open_time"].max().rename("t").reset_index()
        last = feats.join(spark.createDataFrame(newest), "symbol").filter("open_time = t")
        made = m.predict_stacking(fitted, last).select("symbol", "y_pred").toPandas()
        for symbol, y in zip(made["symbol"], made["y_pred"]):
            assert got[symbol, step] == pytest.approx(y, rel=1e-9), (symbol, step)
        added = now.sort_values("open_time").groupby("symbol").tail(1).merge(made, on="symbol")
        added = added.assign(close=added["y_pred"], open_time=added["open_time"] + pd.Timedelta(days=1)).drop(columns="y_pred")
        now = pd.concat([now, added])


def write_in_parts(spark, pdf, path, parts):
    for i, part in enumerate(np.array_split(pdf, parts)):
        spark.createDataFrame(part.sample(frac=1, random_state=i)).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_over_several_batches(spark, tmp_path):
    pdf = candle_rows(200, "A", "1h", seed=7)
    path = str(tmp_path / "in")
    write_in_parts(spark, pdf, path, 4)
    df = spark.read.parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    s.run_to_files(s.stream_indicators(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out")).toPandas().sort_values("open_time")
    defs = [f.macd_def(), f.ema_def(), f.rsi_wilder_def(), f.atr_wilder_def(), f.drawdown_def()]
    want = f.with_indicators(df, defs).toPandas().sort_values("open_time")
    assert not got["late"].any()
    for col in ("ema_12", "macd_signal", "rsi_14", "atr_14", "drawdown_pct"):
        np.testing.assert_allclose(got[col], want[col], rtol=1e-9, atol=1e-9, err_msg=col)


def test_late_rows_are_marked(spark, tmp_path):
    pdf = candle_rows(50, "A", "1h", seed=7)
    path = str(tmp_path / "in")
    write_in_parts(spark, pd.concat([pdf[:10], pdf[20:], pdf[12:15]]), path, 1)
    for part in (pdf[:10], pdf[20:], pdf[12:15]):
        write_in_parts(spark, part, path + "2", 1)
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path + "2")
    s.run_to_files(s.stream_indicators(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 43 and got.filter("late").count() == 3


def test_stream_upsert_is_idempotent(spark, tmp_path):
    table, log, tmp = (str(tmp_path / x) for x in ("table", "log", "tmp"))
    store.init_store(spark, table)
    batch = spark.createDataFrame(candle_rows(30)).withColumn("seq", F.lit(1))
    run = s.upsert_batch(spark, table, log, tmp)
    run(batch, 0)
    run(batch, 0)
    run(batch.withColumn("close", F.col("close")), 1)
    assert store.read_store(spark, table).count() == 30
    runs = {r.run_id: r for r in store.audit_log(spark.read.parquet(log)).collect()}
    assert set(runs) == {"batch-0", "batch-1"} and runs["batch-1"].rows_updated == 30
    assert all(r.status == "success" for r in runs.values())


def test_repeated_batch_reports_the_same_counts(spark, tmp_path, monkeypatch):
    table, log, tmp = (str(tmp_path / x) for x in ("table", "log", "tmp"))
    store.init_store(spark, table)
    run = s.upsert_batch(spark, table, log, tmp, query="q")
    first = spark.createDataFrame(candle_rows(30)).withColumn("seq", F.lit(1))
    later = spark.createDataFrame(candle_rows(40)).withColumn("seq", F.lit(1))
    run(first, 0)

    def lost(*_):
        raise RuntimeError("executor lost")

    write = store.write_candles
    monkeypatch.setattr(store, "write_candles", lost)  # the merge is complete, the table is not replaced
    with pytest.raises(RuntimeError):
        run(later, 1)
    monkeypatch.setattr(store, "write_candles", write)
    for _ in range(2):
        run(later, 1)
        assert store.read_store(spark, table).count() == 40
        runs = {r.run_id: r for r in store.audit_log(spark.read.parquet(log)).collect()}
        assert (runs["q-0"].rows_inserted, runs["q-0"].rows_updated) == (30, 0)
        assert (runs["q-1"].rows_inserted, runs["q-1"].rows_updated, runs["q-1"].status) == (10, 30, "success")
    assert spark.read.parquet(log).filter("run_id = 'q-1'").count() == 2


def test_touched_months_are_listed(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "table")
    store.init_store(spark, table)
    store.write_candles(spark.createDataFrame(candle_rows(900)).withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()}), table)
    ends = spark.createDataFrame(candle_rows(900)).filter("open_time < '2023-01-03' or open_time > '2025-06-10'").withColumn("month", store._month())
    for listed in (500, 1):
        monkeypatch.setattr(store, "LISTED", listed)
        got = store.touched_partitions(store.read_store(spark, table), ends)
        assert got.select("month").distinct().count() == 2 and got.count() == 31 + 18


def test_audit_of_failed_run(spark):
    series = spark.createDataFrame([("A", "1d")], "symbol string, timeframe string")
    started = store.log_start(series, "initial", F.lit(datetime(2024, 1, 1)), "r")
    done = store.log_finish(started, None, F.lit(datetime(2024, 1, 2)), "boom")
    r = store.audit_log(started.unionByName(done)).first()
    assert (r.status, r.error_message, r.finished_at) == ("error", "boom", datetime(2024, 1, 2))
