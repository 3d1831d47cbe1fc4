"""Clusters and projections of each series against plain versions."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wickframe.operators import cluster as c

FEATS = ["a", "b", "d"]


@pytest.fixture(scope="module")
def scaled(spark):
    rng = np.random.default_rng(3)
    frames = []
    for symbol, n, centres in (("A", 260, 3), ("B", 40, 2), ("C", 7, 2), ("D", 1, 1)):
        at = rng.integers(centres, size=n)
        x = rng.normal(size=(n, 3)) * 0.4 + np.array([[0, 0, 0], [4, 0, 1], [0, 5, -2]])[at]
        frames.append(pd.DataFrame(x, columns=FEATS).assign(symbol=symbol, timeframe="1d", open_time=pd.date_range("2024-01-01", periods=n)))
    pdf = pd.concat(frames)[["symbol", "timeframe", "open_time", *FEATS]]
    return pdf, spark.createDataFrame(pdf).repartition(5)


def silhouette(x, labels):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    out = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == k].mean() for k in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return np.mean(out)


@pytest.mark.parametrize("sample", [2000, 20])
def test_kmeans_per_series(scaled, sample):
    pdf, df = scaled
    fit = {"sample": sample, "starts": 5}
    sweep = c.kmeans_sweep(df, (2, 4), **fit).toPandas()
    assert sorted(sweep.groupby("symbol")["k"].apply(sorted).items()) == [("A", [2, 3, 4]), ("B", [2, 3, 4]), ("C", [2, 3, 4])]
    assert sweep[sweep["best"]].groupby("symbol").size().eq(1).all()
    assert sweep[(sweep["symbol"] == "A") & sweep["best"]]["k"].item() == 3
    for k in (2, 3, 4):
        labels = c.kmeans_labels(df, k, k_range=(k, k), **fit).toPandas()
        for symbol in "ABC":
            rows = labels[labels["symbol"] == symbol].sort_values("open_time")
            x, at = rows[FEATS].to_numpy(), rows["cluster"].to_numpy()
            assert len(x) == (pdf["symbol"] == symbol).sum()
            centres = np.array([x[at == i].mean(axis=0) if (at == i).any() else np.full(3, np.inf) for i in range(k)])
            assert (((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1) == at).all()  # a fixed point of the iteration
    best = c.kmeans_labels(df, k_range=(2, 4), **fit).toPandas()
    for symbol in "AB":
        rows = best[best["symbol"] == symbol].sort_values("open_time")
        x, at = rows[FEATS].to_numpy(), rows["cluster"].to_numpy()
        want = sweep[(sweep["symbol"] == symbol) & sweep["best"]].iloc[0]
        assert len(set(at)) == want["k"]
        assert want["inertia"] == pytest.approx(sum(((x[at == i] - x[at == i].mean(axis=0)) ** 2).sum() for i in set(at)))
        assert want["silhouette"] == pytest.approx(silhouette(x, at))
    profile = c.cluster_profile(c.kmeans_labels(df, 2, **fit)).toPandas()
    assert profile.groupby("symbol")["pct"].sum().round(9).eq(100).all()
    assert profile.groupby("symbol")["size"].sum().to_dict() == {"A": 260, "B": 40, "C": 7}


def plain_ward(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        def cost(p):
            a, b = x[groups[p[0]]], x[groups[p[1]]]
            return len(a) * len(b) / (len(a) + len(b)) * ((a.mean(axis=0) - b.mean(axis=0)) ** 2).sum()

        i, j = min(itertools.combinations(range(len(groups)), 2), key=cost)
        groups[i] += groups.pop(j)
    return {frozenset(g) for g in groups}


def test_ward_equals_plain_agglomeration():
    rng = np.random.default_rng(2)
    for n, k in ((1, 3), (2, 2), (5, 2), (40, 4), (40, 1)):
        x = rng.normal(size=(n, 2))
        labels = c.ward(x, np.ones(n), k)
        assert {frozenset(np.flatnonzero(labels == i)) for i in set(labels)} == plain_ward(x, k)


def test_hierarchy_per_series(scaled):
    pdf, df = scaled
    got = c.hierarchical_clusters(df, 3).toPandas()
    assert len(got) == len(pdf)
    for symbol, rows in got.groupby("symbol"):
        rows = rows.sort_values("open_time")
        x, at = rows[FEATS].to_numpy(), rows["cluster"].to_numpy()
        if len(x) < 100:
            assert {frozenset(np.flatnonzero(at == i)) for i in set(at)} == plain_ward(x, 3)
    few = c.hierarchical_clusters(df, 3, micro=30).toPandas()
    a, b = (g[g["symbol"] == "A"].sort_values("open_time")["cluster"].to_numpy() for g in (got, few))
    agree = max(np.mean(np.array(p)[b] == a) for p in itertools.permutations(range(3)))
    assert len(few) == len(pdf) and agree > 0.95


def test_projection_per_series(scaled):
    pdf, df = scaled
    got = c.pca_2d(df).toPandas()
    assert len(got) == len(pdf)
    for symbol, rows in got.groupby("symbol"):
        x = pdf[pdf["symbol"] == symbol].sort_values("open_time")[FEATS].to_numpy()
        rows = rows.sort_values("open_time")
        u, s, _ = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
        if len(x) > 3:
            for i, name in enumerate(("pc1", "pc2")):
                np.testing.assert_allclose(np.abs(rows[name]), np.abs(u[:, i] * s[i]), atol=1e-8)
                np.testing.assert_allclose(rows[f"explained_{i + 1}"], 100 * s[i] ** 2 / (s**2).sum())


def test_empty_clusters(scaled):
    _, df = scaled
    none = df.filter(F.lit(False))
    for out in (c.kmeans_sweep(none, (2, 3)), c.kmeans_labels(none, 2), c.hierarchical_clusters(none, 2), c.pca_2d(none)):
        assert out.count() == 0
