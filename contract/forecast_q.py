"""Forecasting queries and their SQL. Predictions that need no model come from simple rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.common import BARS_1D, BARS_1H, S, W, out, rsql
from contract.features_q import BASE, features_cte
from wickframe.operators import features as f
from wickframe.operators import forecast as m
from wickframe.operators import metrics as t
from wickframe.operators.blocks import drop_index, index_series
from wickframe.operators.supervised import time_index
from wickframe.schema import SERIES, TIME
from wickframe.sources import store
from wickframe.sources.adapters import bars_1d, bars_1h

K2 = "symbol, timeframe"
FOLDS, STEPS = 5, 7
_FITTED: dict = {}  # the model of the last session and folder; seven queries use the same one


def rule(spark, sf):
    """``y`` = close and a 7-bar mean as its prediction."""
    b = f.moving_averages(bars_1d(spark, sf))
    return b.select(*SERIES, TIME, F.col("close").alias("y"), F.col("ma_7").alias("y_pred")).filter("y_pred is not null")


def banded(spark, sf):
    return t.conformal_intervals(rule(spark, sf), t.conformal_quantiles(rule(spark, sf)))


def spread(spark, sf):
    r = rule(spark, sf)
    return r.withColumns({c: F.col("y_pred") * (0.5 + q) for c, q in t.QUANTILES.items()})


def steps(spark, sf):
    last = store.latest_price(bars_1h(spark, sf))
    return last.select(*SERIES, F.explode(F.sequence(F.lit(1), F.lit(7))).alias("step"), "close", "open").select(
        *SERIES, F.col("step").cast("bigint"), (F.col("close") * 0.5 + F.col("open") * 0.5 + F.col("step")).alias("y_pred")
    )


def windows(spark, sf):
    """Quantiles of log returns for windows of 3 steps: one window per bar, the bar's own return scaled."""
    r = time_index(f.returns(bars_1h(spark, sf).filter("close > 0"))).filter("log_return is not null")
    x = r.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(3))))
    return x.select(
        *SERIES, F.col("time_idx").alias("window"), F.col("step").cast("bigint"),
        *[(F.col("log_return") * (q - 0.4) / (1 + F.col("step"))).alias(c) for c, q in t.QUANTILES.items()],
    )


def many(spark, sf):
    preds = None
    for i, name in enumerate(("a", "b", "c", "d")):
        p = windows(spark, sf).select("*", F.lit(name).alias("model"))
        p = p.withColumns({c: F.col(c) * (i + 1) for c in t.QUANTILES})
        preds = p if preds is None else preds.unionByName(p)
    days = store.latest_price(bars_1h(spark, sf)).agg(F.avg("close").alias("v"))
    losses = days.select(F.explode(F.array(*[F.struct(F.lit(n).alias("model"), (F.col("v") * k).alias("val_loss")) for n, k in (("a", 3), ("b", 1), ("c", 9), ("d", 2))])).alias("s")).select("s.*")
    return t.ensemble_mean(preds, losses)


def folds(spark, sf):
    from wickframe.operators.supervised import time_series_folds

    x = time_series_folds(bars_1d(spark, sf)).filter("fold > 0")
    return t.cv_summary(x.groupBy(*SERIES, "fold").agg(F.avg(F.abs(F.col("close") - F.col("open"))).alias("val_loss")), by=SERIES)


def rows(spark, sf, folds=FOLDS):
    return m.split_rows(m.supervised_rows(bars_1h(spark, sf)), folds=folds)


def fitted(spark, sf):
    """Model with default learners, and its rows."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        r = m.cut(rows(spark, sf))
        model = m.calibrate(m.fit_stacking(r.filter("part = 'train'")), r.filter("part = 'calibration'"))
        _FITTED.clear()
        _FITTED[key] = model, r
    return _FITTED[key]


def _oof(spark, sf):
    r = m.cut(rows(spark, sf)).filter("part = 'train'")
    return m.oof_predictions(r, m.feature_columns(r, exclude=("y", "fold"))).select(*SERIES, TIME, "fold", "y", "oof_gbt", "oof_forest")


def _stack(spark, sf):
    model, r = fitted(spark, sf)
    return m.predict_stacking(model, r.filter("part = 'test'")).select(*SERIES, TIME, "y", "y_pred")


def _batch(spark, sf):
    model, r = fitted(spark, sf)
    return m.predict_batch(model, r.filter("part = 'test'")).select(*SERIES, TIME, "y", "y_pred", "lower_80", "upper_80", "lower_90", "upper_90")


def _scores(spark, sf):
    model, r = fitted(spark, sf)
    p = m.predict_batch(model, r.filter("part = 'test'"))
    return t.point_metrics(p).join(t.interval_metrics(p), list(SERIES))


def _importance(spark, sf):
    model, _ = fitted(spark, sf)
    return m.feature_importance(model, spark)


def _tune(spark, sf):
    """All trials of both learners at the tuner's defaults, over three folds."""
    r = m.cut(rows(spark, sf, 3).filter("part = 'train'"))
    _, trials = m.tune_all(r, m.feature_columns(r, exclude=("y", "fold")))
    flat = [(x["learner"], x["trial"], x["score"], x["pruned"], x["folds"], {k: float(v) for k, v in x["params"].items()}) for x in trials]
    found = spark.createDataFrame(flat, "learner string, trial long, score double, pruned boolean, folds long, params map<string,double>")
    names = {"maxIter": "rounds", "numTrees": "num_trees", "maxDepth": "max_depth", "stepSize": "step_size", "subsamplingRate": "subsampling"}
    return found.select("learner", "trial", "score", "pruned", "folds", *[F.col("params")[k].alias(c) for k, c in names.items()])


def _recursive(mode):
    def run(spark, sf):
        model, _ = fitted(spark, sf)
        return m.recursive_forecast(model, bars_1h(spark, sf), STEPS, mode)

    return run


def _saved(spark, sf):
    import tempfile

    model, r = fitted(spark, sf)
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="wickframe-")
    import uuid

    path = f"{base}/model-{uuid.uuid4().hex}"
    m.save_model(model, path)
    loaded = m.load_model(spark, path)
    return m.predict_batch(loaded, r.filter("part = 'test'")).select(*SERIES, TIME, "y_pred", "lower_90", "upper_90")


QUERIES = {
    "baseline_forecasts": lambda x, d: out(t.baseline_forecasts(bars_1d(x, d)), 4),
    "point_metrics": lambda x, d: out(t.point_metrics(rule(x, d)), 4),
    "interval_metrics": lambda x, d: out(t.interval_metrics(banded(x, d)), 4),
    "conformal_quantiles": lambda x, d: out(t.conformal_quantiles(rule(x, d)), 4),
    "conformal_intervals": lambda x, d: out(banded(x, d), 4),
    "quantile_loss": lambda x, d: out(t.quantile_loss(spread(x, d)), 4),
    "forecast_timestamps": lambda x, d: out(t.forecast_timestamps(steps(x, d), store.latest_price(bars_1h(x, d)))),
    "quantile_forecast": lambda x, d: out(t.quantile_forecast(f.trend_regime(bars_1d(x, d)))),
    "reconstruct_close": lambda x, d: out(t.reconstruct_close(windows(x, d), bars_1h(x, d)).select(*SERIES, "window", "step", "close_q50", "close_q10", "close_q90")),
    "ensemble_mean": lambda x, d: out(many(x, d)),
    "cv_summary": lambda x, d: out(folds(x, d), 4),
    "oof_predictions": lambda x, d: out(_oof(x, d)),
    "fit_stacking": lambda x, d: out(_scores(x, d)),
    "predict_stacking": lambda x, d: out(_stack(x, d)),
    "predict_batch": lambda x, d: out(_batch(x, d)),
    "feature_importance": lambda x, d: out(_importance(x, d)),
    "tune_hyperparams": lambda x, d: out(_tune(x, d)),
    "model_store": lambda x, d: out(_saved(x, d)),
    "recursive_forecast": lambda x, d: out(_recursive("reference")(x, d)),
    "recursive_forecast_full": lambda x, d: out(_recursive("full")(x, d)),
}

B1D = f"bars as ({BARS_1D})"
RULE = f"""with {B1D}, r as (select symbol, timeframe, open_time, close as y, avg(close) over (partition by symbol, timeframe order by open_time rows between 6 preceding and current row) as p
  from bars qualify row_number() over {W} >= 7)"""
QS = RULE + ", q as (select symbol, timeframe, count(*) as n, quantile_cont(abs(y - p), 0.8::double) as q80, quantile_cont(abs(y - p), 0.9::double) as q90, quantile_cont(abs(y - p), 0.95::double) as q95 from r group by 1, 2)"
BANDS = QS + ", b as (select r.*, p - q80 as lower_80, p + q80 as upper_80, p - q90 as lower_90, p + q90 as upper_90 from r join q using (symbol, timeframe))"
POINT = {
    "mae": "avg(abs(y - p))",
    "rmse": "sqrt(avg((y - p) ** 2))",
    "mape": "avg(abs(y - p) / (abs(y) + 1e-8::double)) * 100",
    "smape": "avg(abs(y - p) / ((abs(y) + abs(p)) / 2 + 1e-8::double)) * 100",
    "r2": "1 - sum((y - p) ** 2) / (var_pop(y) * count(*))",
}


def winkler(k):
    a = round(1 - k / 100, 10)
    lo, hi = f"lower_{k}", f"upper_{k}"
    return {
        f"winkler_{k}": f"avg({hi} - {lo} + case when y < {lo} then {2 / a!r}::double * ({lo} - y) when y > {hi} then {2 / a!r}::double * (y - {hi}) else 0 end)",
        f"coverage_{k}": f"avg(case when y between {lo} and {hi} then 1.0::double else 0 end) * 100",
    }


LOSS = {f"loss_{c}": f"avg(greatest({q}::double * (y - p * (0.5::double + {q}::double)), ({q}::double - 1) * (y - p * (0.5::double + {q}::double))))" for c, q in t.QUANTILES.items()}
WINDOWS = f"""with bars as ({BARS_1H}), n as (select *, ln(close / lag(close) over {W}) as lr, row_number() over {W} - 1 as rn, count(*) over {S} as n from bars),
 w as (select symbol, timeframe, rn as "window", step, n, {', '.join(f'lr * ({q!r}::double - 0.4::double) / (1 + step) as {c}' for c, q in t.QUANTILES.items())}
       from n, (select unnest([1, 2, 3])::bigint as step) where lr is not null)"""
QN = {c: f"quantile_cont(r, {q!r}::double)" for c, q in t.QUANTILES.items()}
SQL = {
    "baseline_forecasts": f"""with recursive {B1D}, n as (select *, row_number() over {W} - 1 as rn from bars),
      e as (select symbol, timeframe, rn, close as e from n where rn = 0 union all select n.symbol, n.timeframe, n.rn, (2.0::double / 15) * n.close + (13.0::double / 15) * e.e from e join n on n.symbol = e.symbol and n.rn = e.rn + 1),
      p as (select n.symbol, n.timeframe, close as y, lag(close) over (partition by n.symbol order by n.rn) as naive,
        case when n.rn >= 7 then avg(close) over (partition by n.symbol order by n.rn rows between 7 preceding and 1 preceding) end as sma_7,
        case when n.rn >= 25 then avg(close) over (partition by n.symbol order by n.rn rows between 25 preceding and 1 preceding) end as sma_25,
        lag(e) over (partition by n.symbol order by n.rn) as ewm_14 from n join e on n.symbol = e.symbol and n.rn = e.rn),
      l as (select {K2}, y, unnest(['naive', 'sma_7', 'sma_25', 'ewm_14']) as model, unnest([naive, sma_7, sma_25, ewm_14]) as p from p)
      select {K2}, model, count(*) as n, {rsql({k: POINT[k] for k in ('mae', 'rmse', 'mape')}, 4)} from l where p is not null group by {K2}, model""",
    "point_metrics": f"{RULE} select {K2}, count(*) as n, {rsql(POINT, 4)} from r group by 1, 2",
    "interval_metrics": f"{BANDS} select {K2}, {rsql({**winkler(80), **winkler(90)}, 4)} from b group by 1, 2",
    "conformal_quantiles": f"{QS} select {K2}, n, {rsql(['q80', 'q90', 'q95'], 4)} from q",
    "conformal_intervals": f"{BANDS} select {K2}, open_time, {rsql({'y': 'y', 'y_pred': 'p', **{c: c for c in ('lower_80', 'upper_80', 'lower_90', 'upper_90')}}, 4)} from b",
    "quantile_loss": f"{RULE} select {K2}, {rsql({**LOSS, 'loss': '(' + ' + '.join(LOSS.values()) + ') / 7'}, 4)} from r group by 1, 2",
    "forecast_timestamps": f"""with bars as ({BARS_1H}), l as (select * from bars qualify row_number() over (partition by symbol, timeframe order by open_time desc) = 1),
      s as (select *, unnest(range(1, 8)) as step from l), p as (select *, close * 0.5::double + open * 0.5::double + step as p from s)
      select {K2}, step, open_time + step * interval 1 hour as forecast_time, {rsql({'y_pred': 'p', 'last_close': 'close', 'diff': 'p - close', 'diff_pct': '(p - close) / close * 100'})} from p""",
    "quantile_forecast": f"""with recursive {BASE.replace(BARS_1H, BARS_1D)}, {features_cte()}, h as (select {K2}, regime, {', '.join(f'ln(lead(close, {h}) over {W} / close) as h{h}' for h in range(1, 8))} from features),
      l as (select {K2}, regime, unnest(range(1, 8)) as step, unnest([{', '.join(f'h{h}' for h in range(1, 8))}]) as r from h)
      select {K2}, regime, step, count(*) as n, {rsql(QN)} from l where r is not null group by {K2}, regime, step""",
    "reconstruct_close": f"""{WINDOWS} select w.symbol, w.timeframe, w.window, w.step, {rsql({f'close_{q}': f'b.close * exp(sum(w.{q}) over (partition by w.symbol, w.window order by w.step))' for q in ('q50', 'q10', 'q90')})}
      from w join n b on b.symbol = w.symbol and b.rn = least(w.window + 29, w.n - 1)""",
    "ensemble_mean": f"{WINDOWS} select {K2}, \"window\", step, {rsql({c: f'{c} * (1 + 2 + 4) / 3.0::double' for c in t.QUANTILES})} from w",
    "cv_summary": f"""with {B1D}, n as (select *, row_number() over {W} - 1 as rn, count(*) over {S} as n from bars),
      f as (select *, (rn - (n - 5 * (n // 6))) // (n // 6) + 1 as fold from n where rn >= n - 5 * (n // 6)), l as (select {K2}, fold, avg(abs(close - open)) as v from f group by 1, 2, 3)
      select {K2}, round(avg(v), 4) as mean, round(stddev_pop(v), 4) as std, count(*) as folds from l group by 1, 2""",
}
