"""Stacked forecaster on Spark ML: two tree learners and a linear learner on their out-of-fold predictions.

One model is trained over the rows of all series; every fit is a distributed Spark job.
"""

from __future__ import annotations

import json
import random
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickframe.operators.blocks import DEFAULT, Layout, drop_index, index_series
from wickframe.operators.metrics import conformal_intervals, conformal_quantiles
from wickframe.operators.search import Trial, ranked, suggest, worse_than_median
from wickframe.operators.supervised import LAGS, ROLLS, SPANS, build_lag_features, feature_columns
from wickframe.plans.lineage import cut
from wickframe.schema import SERIES, TIME
from wickframe.sources.store import latest_n

TAIL = max(*ROLLS, *LAGS, 36 * (max(SPANS) + 1))  # (1 - 2 / (span + 1)) ** (36 * (span + 1)) is about exp(-72)
BASES = ("gbt", "forest")
SIDE = 6  # learners fitted side by side: each fit is a chain of many short jobs
META = {"ridge": (None, 0.0), "lasso": (0.01, 1.0), "elasticnet": (0.01, 0.5)}
DEFAULTS = {"gbt": {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1}, "forest": {"numTrees": 20, "maxDepth": 6}}
# Search ranges of the tuner (low, high, scale).
SPACE = {
    "gbt": {"maxIter": (5, 40, "int"), "maxDepth": (2, 6, "int"), "stepSize": (0.005, 0.3, "log"), "subsamplingRate": (0.5, 1.0, "float")},
    "forest": {"numTrees": (5, 40, "int"), "maxDepth": (3, 8, "int"), "subsamplingRate": (0.5, 1.0, "float")},
}


@dataclass
class Stacking:
    """Fitted learners, the frozen feature list and the interval quantiles per series."""

    features: list[str]
    bases: dict[str, object]
    meta: object
    target: str = "close"
    fold_scores: list[dict] = field(default_factory=list)
    quantiles: DataFrame | None = None


def supervised_rows(df: DataFrame, target: str = "close", horizon: int = 1, layout: Layout = DEFAULT) -> DataFrame:
    """Lagged features and ``y``, built before any split and materialised for the fits."""
    return cut(build_lag_features(df, target, True, layout, ahead_of=horizon).filter(F.col("y").isNotNull()))


def split_rows(rows: DataFrame, test_ratio: float = 0.15, calibration_ratio: float = 0.15, folds: int = 3, layout: Layout = DEFAULT) -> DataFrame:
    """Per series: ``part`` train, calibration or test, and the expanding-fold number inside train."""
    cut_at = F.floor(F.col("_total") * F.lit(1 - test_ratio))
    cal = F.floor(cut_at * F.lit(1 - calibration_ratio))
    size = F.floor(cal / (folds + 1))
    start = cal - folds * size
    rn = F.col("_rn")
    part = F.when(rn < cal, "train").when(rn < cut_at, "calibration").otherwise("test")
    fold = F.when((rn < cal) & (rn >= start) & (size > 0), F.floor((rn - start) / size) + 1).when(rn < cal, 0)
    return drop_index(index_series(rows, layout=layout).withColumns({"part": part, "fold": fold.cast("bigint")}))


def _learner(name: str, params: dict, seed: int = 42):
    cls = {"gbt": GBTRegressor, "forest": RandomForestRegressor}[name]
    return cls(featuresCol="_x", labelCol="y", predictionCol=f"_{name}", seed=seed, **{**DEFAULTS[name], **params})


def _assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="error").transform(df)


def _folds(rows: DataFrame) -> list[int]:
    return [r[0] for r in rows.filter("fold > 0").select("fold").distinct().orderBy("fold").collect()]


def _fit_learners(x: DataFrame, wanted: list[tuple[str, int | None]], params: dict) -> dict:
    """Fitted learners by (name, fold): on the rows before the fold, or on all rows without one.

    The fits do not depend on each other, so ``SIDE`` run at a time; each reads the same kept inputs in the same parts.
    """
    kept = x.select("_x", "y", "fold").persist()

    def fit(name: str, k: int | None):
        return _learner(name, params.get(name, {})).fit(kept if k is None else kept.filter(F.col("fold") < k))

    order = sorted(wanted, key=lambda w: (w[0] != BASES[0], w[1] is not None, -(w[1] or 0)))  # the longest fits first
    try:
        with ThreadPool(SIDE) as pool:
            fits = pool.map(inheritable_thread_target(x.sparkSession)(lambda w: fit(*w)), order, chunksize=1)
    finally:
        kept.unpersist()
    return dict(zip(order, fits))


def _out_of_fold(x: DataFrame, folds: list[int], models: dict) -> DataFrame:
    out = None
    for k in folds:
        part = x.filter(F.col("fold") == k)
        for name in BASES:
            part = models[name, k].transform(part)
        out = part if out is None else out.unionByName(part)
    return out.drop("_x").withColumnsRenamed({f"_{n}": f"oof_{n}" for n in BASES})


def oof_predictions(rows: DataFrame, features: list[str], params: dict | None = None) -> DataFrame:
    """Out-of-fold predictions of both learners for the rows with a fold number above 0."""
    x, folds = _assemble(rows, features), _folds(rows)
    return _out_of_fold(x, folds, _fit_learners(x, [(n, k) for k in folds for n in BASES], params or {}))


def oof_scores(oof: DataFrame) -> DataFrame:
    """RMSE of every learner per fold."""
    return oof.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), *[F.sqrt(F.avg(F.pow(F.col(f"oof_{n}") - F.col("y"), 2))).alias(f"rmse_{n}") for n in BASES]
    )


def fit_stacking(rows: DataFrame, target: str = "close", meta: str = "ridge", params: dict | None = None, features: list[str] | None = None) -> Stacking:
    """Fit the meta learner on out-of-fold predictions, refit the base learners on all given training rows."""
    params = params or {}
    features = features or feature_columns(rows, target, exclude=("y", "fold"))
    x, folds = _assemble(rows, features), _folds(rows)
    models = _fit_learners(x, [(n, k) for k in [None, *folds] for n in BASES], params)
    oof = cut(_out_of_fold(x, folds, models))
    scores = [r.asDict() for r in oof_scores(oof).orderBy("fold").collect()]
    stacked = VectorAssembler(inputCols=[f"oof_{n}" for n in BASES], outputCol="_m").transform(oof)
    reg, mix = META[meta]
    if reg is None:
        reg = 1.0 / max(sum(s["n"] for s in scores), 1)
    linear = LinearRegression(featuresCol="_m", labelCol="y", predictionCol="y_pred", regParam=reg, elasticNetParam=mix, standardization=False)
    meta_model = linear.fit(stacked)
    bases = {n: models[n, None] for n in BASES}
    return Stacking(features, bases, meta_model, target, scores)


def predict_stacking(model: Stacking, rows: DataFrame) -> DataFrame:
    """Add ``y_pred``."""
    out = _assemble(rows, model.features)
    for n in BASES:
        out = model.bases[n].transform(out)
    out = VectorAssembler(inputCols=[f"_{n}" for n in BASES], outputCol="_m").transform(out)
    return model.meta.transform(out).drop("_x", "_m", *[f"_{n}" for n in BASES])


def calibrate(model: Stacking, calibration: DataFrame, alpha: float = 0.1) -> Stacking:
    """Residual quantiles of rows that no learner was trained on."""
    model.quantiles = cut(conformal_quantiles(predict_stacking(model, calibration), alpha=alpha))
    return model


def predict_batch(model: Stacking, rows: DataFrame) -> DataFrame:
    """One-step predictions with 80 % and 90 % intervals; ``y`` keeps the horizon of training."""
    return conformal_intervals(predict_stacking(model, rows), model.quantiles)


def feature_importance(model: Stacking, spark: SparkSession) -> DataFrame:
    """Importance of every feature per learner, ranked."""
    rows = []
    for name in BASES:
        ranked = sorted(zip(model.features, model.bases[name].featureImportances.toArray()), key=lambda p: (-p[1], p[0]))
        rows += [(name, f, float(v), r) for r, (f, v) in enumerate(ranked, 1)]
    return spark.createDataFrame(rows, "learner string, feature string, importance double, rank long")


def tune_hyperparams(
    rows: DataFrame, learner: str, features: list[str], trials: int = 30, seed: int = 42, startup: int = 5, warmup: int = 1, side: int = 5
) -> tuple[dict, list[dict]]:
    """Adaptive search with expanding folds: best parameters and one record per trial.

    ``side`` trials are fitted side by side, fold by fold; each is chosen from the trials of earlier rounds, and
    stopped where its mean is worse than their median, so the result depends on the seed and not on timing.
    Of equal scores the earlier trial wins; rows without any fold are an error.
    """
    rng = random.Random(seed)
    x = _assemble(rows, features)
    folds = [r[0] for r in rows.filter("fold > 0").select("fold").distinct().orderBy("fold").collect()]
    if not folds:
        raise ValueError("no fold to score on")

    def score(params: dict, k: int) -> float:
        fitted = _learner(learner, params).fit(x.filter(F.col("fold") < k)).transform(x.filter(F.col("fold") == k))
        return fitted.agg(F.sqrt(F.avg(F.pow(F.col(f"_{learner}") - F.col("y"), 2)))).first()[0]

    past: list[Trial] = []
    with ThreadPool(side) as pool:
        while len(past) < trials:
            now = [Trial(len(past) + i, suggest(SPACE[learner], past, rng, startup)) for i in range(min(side, trials - len(past)))]
            for k in folds:
                alive = [t for t in now if not t.pruned]
                scores = pool.map(inheritable_thread_target(rows.sparkSession)(lambda t: score(t.params, k)), alive)
                for trial, value in zip(alive, scores):
                    trial.scores.append(value)
                    trial.pruned = k != folds[-1] and worse_than_median(trial, past, startup, warmup)
            past += now
    records = [{"trial": t.number, "params": t.params, "score": t.score, "pruned": t.pruned, "folds": len(t.scores)} for t in past]
    return ranked(past)[0].params, records


def tune_all(rows: DataFrame, features: list[str], **search) -> tuple[dict[str, dict], list[dict]]:
    """Best parameters of both learners, as ``fit_stacking`` takes them, and the records of all trials."""
    best, records = {}, []
    for name in BASES:
        best[name], found = tune_hyperparams(rows, name, features, **search)
        records += [{"learner": name, **r} for r in found]
    return best, records


def save_model(model: Stacking, path: str) -> None:
    """Learners as Spark ML directories, features as one JSON row, interval quantiles as a table."""
    for n in BASES:
        PipelineModel([model.bases[n]]).write().overwrite().save(f"{path}/{n}")
    PipelineModel([model.meta]).write().overwrite().save(f"{path}/meta")
    spark = SparkSession.getActiveSession()
    side = json.dumps({"features": model.features, "target": model.target, "fold_scores": model.fold_scores})
    spark.createDataFrame([(side,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/info")
    if model.quantiles is not None:
        model.quantiles.write.mode("overwrite").parquet(f"{path}/quantiles")


def load_model(spark: SparkSession, path: str, with_quantiles: bool = True) -> Stacking:
    bases = {n: PipelineModel.load(f"{path}/{n}").stages[0] for n in BASES}
    meta = PipelineModel.load(f"{path}/meta").stages[0]
    info = json.loads(spark.read.text(f"{path}/info").first()[0])
    quantiles = spark.read.parquet(f"{path}/quantiles") if with_quantiles else None
    return Stacking(info["features"], bases, meta, info["target"], info["fold_scores"], quantiles)


def check_request(steps: int, n_history: int | None = None) -> None:
    if not 1 <= steps <= 30:
        raise ValueError("steps must lie between 1 and 30")
    if n_history is not None and not 30 <= n_history <= 1000:
        raise ValueError("n_history must lie between 30 and 1000")


def recursive_forecast(model: Stacking, history: DataFrame, steps: int = 7, mode: str = "reference", layout: Layout = DEFAULT) -> DataFrame:
    """``steps`` predictions per series, each fed back as the newest value; series need 10 candles.

    ``reference``: of the lag features only those whose predecessor lag exists move on, all other
    features stay. ``full``: every lagged feature is recomputed from the predicted values.
    The state is one row per series, so the loop over steps is cheap however many series there are. It is made of the
    newest ``TAIL`` rows: what is older weighs less than 1e-31 in a weighted mean. Features that no row of them defines are 0.
    """
    check_request(steps)
    if mode not in ("reference", "full"):
        raise ValueError(f"unknown mode {mode}")
    t = model.target
    recent = cut(latest_n(history.filter(F.col(TIME).isNotNull()), TAIL))
    feats = build_lag_features(recent, t, drop_na=False, layout=layout)
    counted = index_series(feats, layout=layout, only=F.col("_total") >= 10)
    keep = max(max(LAGS) + 1, max(ROLLS))
    tail = counted.filter(F.col("_rn") >= F.col("_total") - keep)  # a few rows per series
    values = F.transform(F.array_sort(F.collect_list(F.struct("_rn", t))), lambda s: s[t])
    last = tail.groupBy(*SERIES).agg(
        values.alias("_h"), *[F.max_by(c, "_rn").alias(c) for c in model.features], F.max(TIME).alias(TIME)
    )
    state = cut(last.fillna(0.0, model.features))
    out = None
    for step in range(1, steps + 1):
        state = predict_stacking(model, state)
        rows = state.select(*SERIES, F.lit(step).cast("bigint").alias("step"), "y_pred")
        out = rows if out is None else out.unionByName(rows)
        y = F.col("y_pred")
        if mode == "reference":
            moves = {f"{t}_lag_{k}": F.col(f"{t}_lag_{k - 1}") for k in LAGS if k - 1 in LAGS}
            moves[f"{t}_lag_1"] = y
        else:
            state = state.withColumn("_h", _append("_h", y, keep))
            moves = _moved_features(t)
        state = cut(state.withColumns({c: x for c, x in moves.items() if c in model.features}).drop("y_pred"))
    return conformal_intervals(out, model.quantiles) if model.quantiles is not None else out


def _append(h: str, y, keep: int):
    """The last ``keep`` values after adding ``y``."""
    longer = F.concat(F.col(h), F.array(y))
    n = F.least(F.lit(keep), F.size(longer))
    return F.slice(longer, -n, n)


def _squared_from(m):
    def squared(x):
        return (x - m) * (x - m)

    return squared


def _moved_features(t: str) -> dict:
    """Lagged features of the row whose value is the last element of ``_h``."""
    h, y = F.col("_h"), F.element_at("_h", -1)
    cols = {f"{t}_lag_{k}": F.try_element_at(h, F.lit(-k - 1)) for k in LAGS}
    for n in ROLLS:
        part = F.slice(h, -F.least(F.lit(n), F.size(h)), F.least(F.lit(n), F.size(h)))
        m = F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / F.size(part)
        dev = F.aggregate(F.transform(part, _squared_from(m)), F.lit(0.0), lambda a, x: a + x)
        cols[f"{t}_roll_mean_{n}"] = m
        cols[f"{t}_roll_std_{n}"] = F.sqrt(dev / F.greatest(F.size(part) - 1, F.lit(1)))
        if n <= 14:
            cols[f"{t}_roll_min_{n}"], cols[f"{t}_roll_max_{n}"] = F.array_min(part), F.array_max(part)
    for s in SPANS:
        a = 2.0 / (s + 1)
        cols[f"{t}_ewma_{s}"] = a * y + (1 - a) * F.col(f"{t}_ewma_{s}")
    cols[f"{t}_diff_1"] = y - F.try_element_at(h, F.lit(-2))
    cols[f"{t}_diff_7"] = cols[f"{t}_mom_7"] = y - F.try_element_at(h, F.lit(-8))
    return cols
