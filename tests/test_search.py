"""Adaptive search: densities, suggestions, pruning and the tuner on Spark."""

import math
import random
import statistics

import numpy as np
import pytest

from wickframe.operators import forecast
from wickframe.operators.search import Density, Trial, from_unit, ranked, suggest, to_unit, worse_than_median

SPACE = {"a": (0.001, 1.0, "log"), "b": (-2.0, 2.0, "float"), "c": (1, 9, "int")}


def loss(p):
    return (math.log10(p["a"]) + 2) ** 2 + (p["b"] - 0.7) ** 2 + 0.1 * (p["c"] - 6) ** 2


def run(seed, trials, startup=5):
    rng, past = random.Random(seed), []
    for i in range(trials):
        p = suggest(SPACE, past, rng, startup)
        past.append(Trial(i, p, [loss(p)]))
    return past


def test_density_is_one_in_total():
    grid = (np.arange(20_000) + 0.5) / 20_000
    for points in ([], [0.0], [0.3], [0.3, 0.3, 0.31], [0.0, 1.0], [i / 50 for i in range(51)]):
        d = Density(points)
        assert abs(np.mean([d.at(u) for u in grid]) - 1) < 1e-3
    rng = random.Random(1)
    d = Density([0.2, 0.25])
    draws = [d.draw(rng) for _ in range(40_000)]
    share = np.mean([d.at(u) * (u < 0.5) for u in grid])
    assert all(0 <= u <= 1 for u in draws) and abs(np.mean([u < 0.5 for u in draws]) - share) < 0.01


def test_units():
    rng = random.Random(2)
    for bounds in SPACE.values():
        values = [from_unit(rng.random(), *bounds) for _ in range(2000)]
        assert all(bounds[0] <= v <= bounds[1] for v in values)
        assert all(abs(from_unit(to_unit(v, *bounds), *bounds) - v) <= (1 if bounds[2] == "int" else 1e-9) for v in values)
    counts = [sum(from_unit((i + 0.5) / 900, 1, 9, "int") == v for i in range(900)) for v in range(1, 10)]
    assert counts == [100] * 9 and from_unit(1.0, 1, 9, "int") == 9 and from_unit(0.5, 3, 3, "int") == 3


def test_suggestions_beat_random_ones_and_repeat():
    adaptive = [min(t.score for t in run(s, 30)) for s in range(40)]
    blind = [min(t.score for t in run(s, 30, startup=31)) for s in range(40)]
    assert statistics.median(adaptive) < 0.6 * statistics.median(blind)
    assert [t.params for t in run(3, 20)] == [t.params for t in run(3, 20)]


def test_median_pruning():
    past = [Trial(i, {}, [float(i), float(i), 1.0]) for i in range(5)]
    assert worse_than_median(Trial(9, {}, [2.0, 2.1]), past) and not worse_than_median(Trial(9, {}, [2.0, 2.0]), past)
    assert not worse_than_median(Trial(9, {}, [99.0]), past)  # warm-up
    assert not worse_than_median(Trial(9, {}, [9.0, 9.0]), past[:4])  # start-up
    stopped = [Trial(5, {}, [0.0, 0.0], True)] * 9
    assert not worse_than_median(Trial(9, {}, [2.0, 2.0]), past + stopped)  # stopped trials give no level
    assert [t.number for t in ranked([Trial(0, {}, [1.0], True), Trial(1, {}, [5.0, 5.0]), Trial(2, {}, [5.0, 5.0]), Trial(3, {}, [9.0, 9.0], True)])] == [1, 2, 3, 0]


def test_tuner_repeats_and_learns(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(240, 2))
    data = [(float(a), float(b), float(3 * a - b), int(i // 80)) for i, (a, b) in enumerate(x)]
    rows = forecast.cut(spark.createDataFrame(data, "x1 double, x2 double, y double, fold long"))
    first, again = (forecast.tune_hyperparams(rows, "forest", ["x1", "x2"], trials=7, startup=3, side=3) for _ in range(2))
    assert first == again and len(first[1]) == 7
    whole = [r for r in first[1] if not r["pruned"]]
    assert first[0] == min(whole, key=lambda r: (r["score"], r["trial"]))["params"] and all(r["folds"] == 2 for r in whole)
    best, records = forecast.tune_all(rows, ["x1", "x2"], trials=2, side=2)
    assert set(best) == set(forecast.BASES) and [r["learner"] for r in records] == ["gbt", "gbt", "forest", "forest"]
    with pytest.raises(ValueError):
        forecast.tune_hyperparams(rows.filter("fold = 0"), "forest", ["x1", "x2"], trials=1)
