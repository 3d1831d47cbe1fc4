"""Clusters of candles in the space of standardised features.

Density clustering and nearest-neighbour distances are exact. Points are hashed into grid cells on
three of the features; a distance in fewer dimensions is never larger, so all neighbours within
the cell size lie in the 27 cells around a point. Equal points are merged first and carry a
weight. A cell is cut into chunks of bounded size, and tasks compare one chunk with another, so
neither a crowded cell nor its pairs are ever gathered in one place.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickframe.operators.blocks import DEFAULT, Layout, drop_index, index_series, over_block, own, row_blocks, top_per_series
from wickframe.operators.stats import rank_values
from wickframe.plans.lineage import cut, written
from wickframe.schema import SERIES, TIME

KEYS = list(SERIES)
# Features of the clustering.
FEATURES = ("rsi_14", "bb_pct", "bb_width", "macd_hist", "volume_ratio", "rolling_vol_30", "price_zscore", "atr_14", "return_pct")
CHUNK = 2_000


def scale_features(df: DataFrame, features=FEATURES) -> DataFrame:
    """Complete rows, each feature with mean 0 and population deviation 1 within its series."""
    feats = [c for c in features if c in df.columns]
    rows = df.select(*KEYS, TIME, *feats).dropna()
    stats = rows.groupBy(*KEYS).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in feats], *[F.stddev_pop(c).alias(f"_s_{c}") for c in feats]
    )
    scaled = {
        c: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(1.0) for c in feats
    }
    return rows.join(stats, KEYS).select(*KEYS, TIME, *[x.alias(c) for c, x in scaled.items()])


def _feature_names(scaled: DataFrame) -> list[str]:
    return [c for c in scaled.columns if c not in (*KEYS, TIME)]


def _stored_points(scaled: DataFrame) -> tuple[DataFrame, int]:
    """Rows as (series, time, v), written once, and the number of features."""
    names = _feature_names(scaled)
    v = F.array(*[F.col(c).cast("double") for c in names])
    return written(scaled.select(*KEYS, TIME, v.alias("v"))), len(names)


def _sampled(points: DataFrame, size: int) -> DataFrame:
    """Up to ``size`` rows of every series, those whose time has the smallest hashes; the whole series where it is no longer."""
    return top_per_series(points, size, [F.xxhash64(TIME), F.col(TIME)]).drop("_r", "_salt")


def _with_series(points: DataFrame, per_series: DataFrame) -> DataFrame:
    """Join one small row per series; the planner broadcasts it where its stored size allows."""
    return points.join(per_series, KEYS)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(x)), at]


def _lloyd(x: np.ndarray, centres: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    for _ in range(rounds):
        at, _ = _nearest(x, centres)
        n = np.bincount(at, minlength=len(centres))
        sums = np.stack([np.bincount(at, x[:, j], len(centres)) for j in range(x.shape[1])], axis=1)
        moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres, float(_nearest(x, centres)[1].sum())


def _seeded(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Starting centres: each next one is drawn by its squared distance to those before."""
    centres = [x[rng.integers(len(x))]]
    best = ((x - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k:
        total = best.sum()
        at = rng.choice(len(x), p=best / total) if total > 0 else rng.integers(len(x))
        centres.append(x[at])
        best = np.minimum(best, ((x - x[at]) ** 2).sum(axis=1))
    return np.array(centres)


CENTRES = "symbol string, timeframe string, k int, c int, v array<double>"


def _starting_centres(points: DataFrame, k_range, seed: int, sample: int, starts: int) -> DataFrame:
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(TIME)
        x = np.array(pdf["v"].tolist(), float)
        rng = np.random.default_rng(seed)
        rows = []
        for k in range(k_range[0], min(k_range[1], len(x)) + 1):
            centres, _ = min((_lloyd(x, _seeded(x, k, rng), 300) for _ in range(starts)), key=lambda f: f[1])
            rows += [(pdf["symbol"].iloc[0], pdf["timeframe"].iloc[0], k, c, v.tolist()) for c, v in enumerate(centres)]
        return pd.DataFrame(rows, columns=[*KEYS, "k", "c", "v"])

    return _sampled(points, sample).groupBy(*KEYS).applyInPandas(fit, CENTRES)


def _per_batch(points: DataFrame, table: DataFrame, work, schema: str) -> DataFrame:
    """``work(x, rows, pdf)`` for the rows of each series in a batch; ``table`` has some rows per series, with k and c."""
    columns = [c for c in table.columns if c not in KEYS]
    packed = table.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("_t"))

    def run(batches):
        for pdf in batches:
            for _, g in pdf.groupby(KEYS, sort=False):
                rows = pd.DataFrame([r if isinstance(r, dict) else r.asDict() for r in g["_t"].iloc[0]])
                out = work(np.array(g["v"].tolist(), float), rows, g)
                if len(out):
                    yield out.assign(symbol=g["symbol"].iloc[0], timeframe=g["timeframe"].iloc[0])[names]

    names = [f.split()[0] for f in schema.split(", ")]
    return _with_series(points, packed).mapInPandas(run, schema)


def _cluster_sums(points: DataFrame, centres: DataFrame, dims: int) -> DataFrame:
    """Per (series, k, c): rows, sums of the features, of squared lengths and of squared distances to the centre."""
    sums = [f"s{j}" for j in range(dims)]

    def work(x: np.ndarray, rows: pd.DataFrame, _) -> pd.DataFrame:
        out = []
        lengths = (x * x).sum(axis=1)
        for k, part in rows.groupby("k"):
            at, d = _nearest(x, np.array(part["v"].tolist(), float))
            table = pd.DataFrame({"k": k, "c": at, "n": 1, "sq": lengths, "d": d, **{s: x[:, j] for j, s in enumerate(sums)}})
            out.append(table.groupby(["k", "c"], as_index=False).sum())
        return pd.concat(out)

    schema = "symbol string, timeframe string, k int, c int, n bigint, sq double, d double, " + ", ".join(f"{s} double" for s in sums)
    part = _per_batch(points, centres, work, schema)
    return part.groupBy(*KEYS, "k", "c").agg(*[F.sum(s).alias(s) for s in ("n", "sq", "d", *sums)])


def fit_centres(points: DataFrame, dims: int, k_range=(2, 9), seed: int = 42, sample: int = 2_000, starts: int = 10, rounds: int = 300) -> DataFrame:
    """Centres (series, k, c, v) of every series and every k at once, by Lloyd's iteration over all rows.

    The start comes from a bounded sample of each series. Every round is one pass over the rows, in which tasks add up
    their rows before the shuffle, and one small stored table of centres; it ends when no centre moves any more.
    """
    centres = written(_starting_centres(points, k_range, seed, sample, starts))
    for _ in range(rounds):
        sums = _cluster_sums(points, centres, dims).select(*KEYS, "k", "c", F.array(*[F.col(f"s{j}") / F.col("n") for j in range(dims)]).alias("_new"))
        moved = F.exists(F.arrays_zip("v", "_new"), lambda p: F.abs(p["v"] - p["_new"]) > 1e-9 * (1 + F.abs(p["v"])))
        step = centres.join(sums, [*KEYS, "k", "c"], "left").select(
            *KEYS, "k", "c", F.coalesce("_new", "v").alias("v"), F.coalesce(moved, F.lit(False)).alias("_moved")
        )
        step = written(step)
        centres = step.drop("_moved")
        if not step.filter("_moved").limit(1).count():
            break
    return centres


def kmeans_sweep(scaled: DataFrame, k_range=(2, 9), seed: int = 42, **fit) -> DataFrame:
    """Per series and k the inertia and the mean silhouette (squared Euclidean), and whether k has the largest one.

    Clusters of one row have silhouette 0. A series has no k above its number of rows; ties go to the smallest k.
    """
    points, dims = _stored_points(scaled)
    return _scores(points, fit_centres(points, dims, k_range, seed, **fit), dims)


def _scores(points: DataFrame, centres: DataFrame, dims: int) -> DataFrame:
    sums = written(_cluster_sums(points, centres, dims))
    table = centres.join(sums, [*KEYS, "k", "c"], "left").select(
        *KEYS, "k", "c", "v", F.coalesce("n", F.lit(0)).alias("n"), "sq", F.array(*[F.coalesce(f"s{j}", F.lit(0.0)) for j in range(dims)]).alias("s")
    )

    def work(x: np.ndarray, rows: pd.DataFrame, _) -> pd.DataFrame:
        out = []
        lengths = (x * x).sum(axis=1)
        for k, part in rows.groupby("k"):
            at, _ = _nearest(x, np.array(part["v"].tolist(), float))
            n = part["n"].to_numpy(float)
            mean = np.array(part["s"].tolist(), float) / np.maximum(n, 1)[:, None]
            d = lengths[:, None] + (part["sq"].fillna(0).to_numpy(float) / np.maximum(n, 1))[None, :] - 2 * x @ mean.T
            d[:, n == 0] = np.inf
            i = np.arange(len(x))
            own = np.maximum(d[i, at], 0) * n[at] / np.maximum(n[at] - 1, 1)
            d[i, at] = np.inf
            other = d.min(axis=1)
            top = np.maximum(own, other)
            s = np.where((n[at] > 1) & (top > 0) & np.isfinite(top), (other - own) / np.where(top > 0, top, 1.0), 0.0)
            out.append((k, float(s.sum()), len(x)))
        return pd.DataFrame(out, columns=["k", "s", "n"])

    silhouette = _per_batch(points, table, work, "symbol string, timeframe string, k int, s double, n bigint")
    scores = silhouette.groupBy(*KEYS, "k").agg((F.sum("s") / F.sum("n")).alias("silhouette"))
    inertia = sums.groupBy(*KEYS, "k").agg(F.sum("d").alias("inertia"))
    best = F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.desc("silhouette"), "k")) == 1  # over one row per k
    return inertia.join(scores, [*KEYS, "k"]).select(*KEYS, "k", "inertia", "silhouette", best.alias("best"))


def kmeans_labels(scaled: DataFrame, k: int | None = None, seed: int = 42, k_range=(2, 9), **fit) -> DataFrame:
    """The cluster of every row within its series; ``k`` is the same for all series or, by default, the best one of each."""
    points, dims = _stored_points(scaled)
    centres = fit_centres(points, dims, k_range if k is None else (k, k), seed, **fit)
    if k is None:
        best = _scores(points, centres, dims).filter("best").select(*KEYS, "k")
        centres = centres.join(best, [*KEYS, "k"])
    return scaled.join(_labelled(points, centres), [*KEYS, TIME])


def _labelled(points: DataFrame, centres: DataFrame) -> DataFrame:
    def work(x: np.ndarray, rows: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        at, _ = _nearest(x, np.array(rows["v"].tolist(), float))
        return pd.DataFrame({TIME: pdf[TIME].to_numpy(), "cluster": rows["c"].to_numpy()[at]})

    return _per_batch(points, centres, work, f"symbol string, timeframe string, {TIME} timestamp, cluster int")


def ward(x: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Labels of weighted points after Ward's agglomeration into ``k`` clusters, by nearest-neighbour chains."""
    m = len(x)
    if m <= k:
        return np.arange(m)
    w = weight.astype(float).copy()
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2) * (w[:, None] * w[None, :] / (w[:, None] + w[None, :]))
    np.fill_diagonal(d, np.inf)
    alive = np.ones(m, bool)
    chain: list[int] = []
    merges = []
    while len(merges) < m - 1:
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        while True:
            i = chain[-1]
            j = int(d[i].argmin())
            if len(chain) > 1 and d[i, chain[-2]] <= d[i, j]:
                j = chain[-2]
                break
            chain.append(j)
        chain = chain[:-2]
        height = d[i, j]
        rest = alive.copy()
        rest[[i, j]] = False
        total = w[i] + w[j] + w[rest]
        d[i, rest] = ((w[i] + w[rest]) * d[i, rest] + (w[j] + w[rest]) * d[j, rest] - w[rest] * height) / total
        d[rest, i] = d[i, rest]
        d[j], d[:, j], alive[j] = np.inf, np.inf, False
        w[i] += w[j]
        merges.append((height, i, j))
    parent = np.arange(m)

    def root(a: int) -> int:
        while parent[a] != a:
            a = parent[a]
        return a

    # a merge is never higher than one that needs it, so the lowest m - k belong to the cut
    for _, i, j in sorted(merges, key=lambda t: t[0])[: m - k]:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    roots = [root(a) for a in range(m)]
    number = {r: n for n, r in enumerate(dict.fromkeys(roots))}
    return np.array([number[r] for r in roots])


def hierarchical_clusters(scaled: DataFrame, k: int, micro: int = 1_000) -> DataFrame:
    """Ward's agglomeration of every series into ``k`` clusters, numbered by their first row in time.

    A series of up to ``micro`` rows is agglomerated row by row. In a longer one ``micro`` of its rows (those with the smallest
    hashes) gather the rows that are nearest to them, and these groups are agglomerated with their centres and sizes.
    """
    points, dims = _stored_points(scaled)
    chosen = written(_sampled(points, micro).select(*KEYS, F.lit(0).alias("k"), F.row_number().over(Window.partitionBy(*KEYS).orderBy(TIME)).alias("c"), "v", TIME))
    seeds = chosen.drop(TIME)
    sums = written(_cluster_sums(points, seeds.withColumn("c", F.col("c") - 1), dims))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c")
        n = pdf["n"].to_numpy(float)
        x = pdf[[f"s{j}" for j in range(dims)]].to_numpy(float) / n[:, None]
        out = pdf[[*KEYS, "c"]].copy()
        out["label"] = ward(x, n, k)
        return out

    groups = sums.groupBy(*KEYS).applyInPandas(fit, "symbol string, timeframe string, c int, label int")  # at most ``micro`` rows
    near = _labelled(points, seeds.withColumn("c", F.col("c") - 1)).withColumnRenamed("cluster", "c")
    return scaled.join(near.join(groups, [*KEYS, "c"]).select(*KEYS, TIME, F.col("label").alias("cluster")), [*KEYS, TIME])


def cluster_profile(labelled: DataFrame) -> DataFrame:
    """Size, percentage and mean standardised features of every cluster of every series."""
    feats = [c for c in _feature_names(labelled) if c != "cluster"]
    out = labelled.groupBy(*KEYS, "cluster").agg(F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(c) for c in feats])
    total = F.sum("size").over(Window.partitionBy(*KEYS))  # over one row per cluster
    return out.withColumn("pct", F.col("size") / total * 100)


def principal_axes(scaled: DataFrame, components: int = 2) -> DataFrame:
    """Per series and component the axis (largest loading positive), the centre and the share of the variance in percent.

    One aggregate collects means and covariances of all series; only these leave the tasks.
    """
    feats = _feature_names(scaled)
    pairs = [(a, b) for i, a in enumerate(feats) for b in feats[i:]]
    moments = scaled.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in feats]).alias("mean"), F.array(*[F.covar_pop(a, b) for a, b in pairs]).alias("cov")
    )
    d = len(feats)

    def axes(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in pdf.itertuples():
            m = np.zeros((d, d))
            m[np.triu_indices(d)] = row.cov
            values, vectors = np.linalg.eigh(m + np.triu(m, 1).T)
            values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
            total = values.sum()
            for c in range(min(components, d)):
                axis = vectors[:, c] * np.sign(vectors[np.abs(vectors[:, c]).argmax(), c])
                out.append((row.symbol, row.timeframe, c + 1, axis.tolist(), list(row.mean), 100 * values[c] / total if total > 0 else 0.0))
        return pd.DataFrame(out, columns=[*KEYS, "component", "axis", "mean", "explained_pct"])

    schema = "symbol string, timeframe string, component int, axis array<double>, mean array<double>, explained_pct double"
    return moments.mapInPandas(lambda it: map(axes, it), schema)


def pca_2d(scaled: DataFrame) -> DataFrame:
    """First two principal components of every row within its series, and the share of the variance they explain in percent."""
    feats = _feature_names(scaled)
    axes = written(principal_axes(scaled))
    per_series = axes.groupBy(*KEYS).agg(
        F.first("mean").alias("_mean"),
        *[F.max(F.when(F.col("component") == c, F.col(x))).alias(f"_{x}{c}") for c in (1, 2) for x in ("axis", "explained_pct")],
    )
    rows = _with_series(scaled, per_series)

    def along(axis: str):
        return sum(((F.col(c) - F.col("_mean")[i]) * F.col(axis)[i] for i, c in enumerate(feats)), F.lit(0.0))

    return rows.select(
        *KEYS, TIME, along("_axis1").alias("pc1"), along("_axis2").alias("pc2"), F.col("_explained_pct1").alias("explained_1"), F.col("_explained_pct2").alias("explained_2")
    )


def systematic_sample(df: DataFrame, size: int = 300, layout: Layout = DEFAULT) -> DataFrame:
    """Every k-th row of a series, k = n div size (at least 1)."""
    step = F.greatest(F.lit(1), F.floor(F.col("_total") / size))
    return drop_index(index_series(df, layout=layout).filter(F.pmod(F.col("_rn"), step) == 0))


def _points(scaled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the id of their point, and the distinct points with weight; ids are times in microseconds."""
    v = F.array(*_feature_names(scaled))
    rows = scaled.select(*KEYS, TIME, v.alias("v"), F.unix_micros(TIME).alias("_t"))
    points = rows.groupBy(*KEYS, "v").agg(F.min("_t").alias("id"), F.count(F.lit(1)).alias("weight"))
    return rows.join(points.select(*KEYS, "v", "id"), [*KEYS, "v"]), points


CELL = ("c0", "c1", "c2")


def _packed(points: DataFrame, side, columns: list[str], chunk: int = CHUNK) -> DataFrame:
    """Chunks of at most about ``chunk`` points of one cell, as arrays."""
    cells = {c: F.floor(F.col("v")[i] / side) for i, c in enumerate(CELL)}
    at = points.withColumns(cells)
    sizes = at.groupBy(*KEYS, *CELL).agg(F.ceil(F.count(F.lit(1)) / chunk).alias("_chunks"))
    at = at.join(sizes, [*KEYS, *CELL]).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("_chunks")))
    return at.groupBy(*KEYS, *CELL, "chunk").agg(F.collect_list(F.struct("id", "v", *columns)).alias("p"))


def _chunk_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    around = F.array(*[F.struct(*[F.lit(d).alias(f"d{i}") for i, d in enumerate((a, b, c))]) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)])
    wide = left.withColumnRenamed("p", "lp").withColumn("_d", F.explode(around))
    wide = wide.select(*KEYS, "lp", *[(F.col(c) + F.col(f"_d.d{i}")).alias(c) for i, c in enumerate(CELL)])
    return wide.join(right.select(*KEYS, *CELL, F.col("p").alias("rp")), [*KEYS, *CELL])


def _matrix(p) -> np.ndarray:
    return np.array([list(r["v"]) for r in p], dtype=float)


def _distances(lp, rp) -> np.ndarray:
    a, b = _matrix(lp), _matrix(rp)
    d = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        d += (a[:, j, None] - b[None, :, j]) ** 2
    return np.sqrt(d)


def _column(p, name) -> np.ndarray:
    return np.array([r[name] for r in p])


KEY_SCHEMA = "symbol string, timeframe string"


def _over_pairs(pairs: DataFrame, fn, schema: str) -> DataFrame:
    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                cols = fn(row)
                if cols is not None and len(next(iter(cols.values()))):
                    yield pd.DataFrame({"symbol": row.symbol, "timeframe": row.timeframe, **cols})

    return pairs.mapInPandas(run, f"{KEY_SCHEMA}, {schema}")


def knn_distance(scaled: DataFrame, k: int = 5, radius: float = 0.5, rounds: int = 12) -> DataFrame:
    """Distance of every row to its k-th neighbour, the row itself counted first.

    Rows with fewer than k neighbours within the radius go on with twice the radius; the last
    round compares the few that are left with all points of their series.
    """
    rows, points = _points(scaled)
    rows, points = cut(rows), cut(points)
    todo, found = points, None
    for i in range(rounds):
        r = radius * 2**i if i < rounds - 1 else 1e12

        def nearest(row, r=r):
            d = _distances(row.lp, row.rp)
            w = np.minimum(_column(row.rp, "weight"), k)
            ids, out = _column(row.lp, "id"), {"id": [], "d": []}
            for a in range(len(ids)):
                near = np.flatnonzero(d[a] <= r)
                near = near[np.argsort(d[a][near], kind="stable")[:k]]
                ds = np.repeat(d[a][near], w[near])[:k]
                out["id"] += [ids[a]] * len(ds)
                out["d"] += ds.tolist()
            return out

        pairs = _chunk_pairs(_packed(todo, r, []), _packed(points, r, ["weight"]))
        near = _over_pairs(pairs, nearest, "id bigint, d double").groupBy(*KEYS, "id").agg(F.array_sort(F.collect_list("d")).alias("_d"))
        hit = cut(near.filter(F.size("_d") >= k).select(*KEYS, "id", F.col("_d")[k - 1].alias("knn")))
        found = hit if found is None else found.unionByName(hit)
        todo = cut(todo.join(hit, [*KEYS, "id"], "left_anti"))
        if todo.isEmpty():
            break
    return rows.join(found, [*KEYS, "id"], "left").select(*KEYS, TIME, "knn")


def elbow_eps(distances: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """``eps`` per series: value at the largest second difference of the sorted distances, within 0.3 .. 3."""
    ranked = rank_values(distances.filter(F.col("knn").isNotNull()).select(*KEYS, TIME, F.col("knn").alias("x")), layout)
    rows = row_blocks(ranked.withColumns({"_rn": F.col("rank") - 1, "_total": F.col("n")}), 2, layout)
    w = over_block()
    one, two = F.lag("x", 1).over(w), F.lag("x", 2).over(w)
    rows = own(rows.withColumn("_dd", (F.col("x") - one) - (one - two))).filter(F.col("_dd").isNotNull())
    eps = F.max_by("x", F.struct(F.col("_dd"), -F.col("rank")))
    return rows.groupBy(*KEYS).agg(F.round(F.greatest(F.lit(0.3), F.least(F.lit(3.0), eps)), 2).alias("eps"))


def dbscan(scaled: DataFrame, eps: DataFrame | float | None = None, least: int = 5) -> DataFrame:
    """Density clusters per series: ``cluster`` from 0, noise -1.

    A border point joins the cluster of its neighbouring core point with the smallest label.
    """
    if eps is None:
        eps = elbow_eps(knn_distance(scaled))
    rows, points = _points(scaled)
    if isinstance(eps, DataFrame):
        points = points.join(eps, KEYS)
    else:
        points = points.withColumn("eps", F.lit(float(eps)))
    rows, points = cut(rows), cut(points)
    side = F.col("eps")

    def counted(row):
        near = _distances(row.lp, row.rp) <= row.lp[0]["eps"]
        return {"id": _column(row.lp, "id"), "c": near @ _column(row.rp, "weight")}

    packed = _packed(points, side, ["weight", "eps"])
    counts = _over_pairs(_chunk_pairs(packed, packed), counted, "id bigint, c bigint").groupBy(*KEYS, "id").agg(F.sum("c").alias("c"))
    points = cut(points.join(counts, [*KEYS, "id"]).withColumn("core", F.col("c") >= least))
    core = points.filter("core")

    def forest(row):
        near = _distances(row.lp, row.rp) <= row.lp[0]["eps"]
        ids_l, ids_r = _column(row.lp, "id"), _column(row.rp, "id")
        top = np.iinfo("int64").max
        lab_l, lab_r = ids_l.copy(), ids_r.copy()
        while True:  # smallest id of the connected part, within these two chunks
            new_r = np.minimum(lab_r, np.where(near, lab_l[:, None], top).min(axis=0))
            new_l = np.minimum(lab_l, np.where(near, new_r[None, :], top).min(axis=1))
            if (new_l == lab_l).all() and (new_r == lab_r).all():
                break
            lab_l, lab_r = new_l, new_r
        src, dst = np.concatenate([ids_l, ids_r]), np.concatenate([lab_l, lab_r])
        keep = src != dst
        return {"src": src[keep], "dst": dst[keep]}

    packed_core = _packed(core, side, ["eps"])
    edges = cut(_over_pairs(_chunk_pairs(packed_core, packed_core), forest, "src bigint, dst bigint").distinct())
    labels = _components(core.select(*KEYS, "id"), edges)

    def nearest_core(row):
        near = _distances(row.lp, row.rp) <= row.lp[0]["eps"]
        label = np.where(near, _column(row.rp, "label")[None, :], np.iinfo("int64").max).min(axis=1)
        return {"id": _column(row.lp, "id")[near.any(axis=1)], "label": label[near.any(axis=1)]}

    border_pairs = _chunk_pairs(
        _packed(points.filter(~F.col("core")), side, ["eps"]), _packed(core.join(labels, [*KEYS, "id"]), side, ["label"])
    )
    border = _over_pairs(border_pairs, nearest_core, "id bigint, label bigint").groupBy(*KEYS, "id").agg(F.min("label").alias("label"))
    number = labels.select(*KEYS, "label").distinct().withColumn(
        "cluster", F.row_number().over(Window.partitionBy(*KEYS).orderBy("label")) - 1
    )
    named = labels.unionByName(border).join(number, [*KEYS, "label"]).select(*KEYS, "id", "cluster")
    out = rows.join(named, [*KEYS, "id"], "left")
    return out.select(*KEYS, TIME, F.coalesce("cluster", F.lit(-1)).cast("bigint").alias("cluster"))


def _components(nodes: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest id of the connected component of every node.

    Each round takes the smallest label around a node and then the label of that label, so chains
    shrink by more than half; labels are materialised per round.
    """
    both = edges.unionByName(edges.select(*KEYS, F.col("dst").alias("src"), F.col("src").alias("dst")))
    labels = cut(nodes.withColumn("label", F.col("id")))
    for _ in range(rounds):
        around = (
            both.join(labels.withColumnRenamed("id", "dst"), [*KEYS, "dst"]).groupBy(*KEYS, F.col("src").alias("id")).agg(F.min("label").alias("_near"))
        )
        step = labels.join(around, [*KEYS, "id"], "left").select(*KEYS, "id", F.least("label", "_near").alias("_new"), "label")
        parent = step.select(*KEYS, F.col("id").alias("_new"), F.col("_new").alias("_up"))
        step = cut(step.join(parent, [*KEYS, "_new"]).select(*KEYS, "id", F.least("_new", "_up").alias("_new"), "label"))
        changed = not step.filter(F.col("_new") != F.col("label")).isEmpty()
        labels = step.select(*KEYS, "id", F.col("_new").alias("label"))
        if not changed:
            return labels
    raise RuntimeError("components did not settle")


def dbscan_summary(labelled: DataFrame) -> DataFrame:
    """Clusters and noise of every series."""
    noise = F.count_if(F.col("cluster") == -1)
    return labelled.groupBy(*KEYS).agg(
        (F.max("cluster") + 1).alias("clusters"), noise.alias("noise"), (noise / F.count(F.lit(1)) * 100).alias("noise_pct")
    )
