"""Clustering queries and their SQL."""

from __future__ import annotations

from contract.common import out, rsql
from contract.features_q import BASE, features_cte
from wickframe.operators import cluster as c
from wickframe.operators import features as f
from wickframe.schema import SERIES, TIME
from wickframe.sources.adapters import bars_1h


def scaled(spark, sf):
    return c.scale_features(f.with_indicators(bars_1h(spark, sf), f.train_indicators()))


def _sample(spark, sf):
    return c.systematic_sample(bars_1h(spark, sf).select(*SERIES, TIME, "close"))


QUERIES = {
    "scale_features": lambda x, d: out(scaled(x, d), 5),
    "kmeans_sweep": lambda x, d: out(c.kmeans_sweep(scaled(x, d)), 5),
    "kmeans_labels": lambda x, d: out(c.kmeans_labels(scaled(x, d)).select(*SERIES, TIME, "cluster")),
    "cluster_profile": lambda x, d: out(c.cluster_profile(c.kmeans_labels(scaled(x, d)))),
    "hierarchical_clusters": lambda x, d: out(c.hierarchical_clusters(scaled(x, d), 4).select(*SERIES, TIME, "cluster")),
    "pca_2d": lambda x, d: out(c.pca_2d(scaled(x, d)), 5),
    "systematic_sample": lambda x, d: out(_sample(x, d)),
    "knn_distance": lambda x, d: out(c.knn_distance(scaled(x, d)), 5),
    "elbow_eps": lambda x, d: out(c.elbow_eps(c.knn_distance(scaled(x, d)))),
    "dbscan": lambda x, d: out(c.dbscan(scaled(x, d))),
    "dbscan_summary": lambda x, d: out(c.dbscan_summary(c.dbscan(scaled(x, d), 1.0))),
}

COMPLETE = " and ".join(f"{n} is not null" for n in c.FEATURES)
Z = {n: f"({n} - avg({n}) over s) / stddev_pop({n}) over s" for n in c.FEATURES}
SCALED = f"with recursive {BASE}, {features_cte()}, k as (select * from features where {COMPLETE})"
ZS = f"{SCALED}, z as (select symbol, timeframe, open_time, {', '.join(f'{x} as {n}' for n, x in Z.items())} from k window s as (partition by symbol, timeframe))"
DIST = " + ".join(f"(a.{n} - b.{n}) ** 2" for n in c.FEATURES)
KNN = f"""{ZS}, p as (select a.symbol, a.timeframe, a.open_time, sqrt({DIST}) as d from z a join z b on a.symbol = b.symbol and a.timeframe = b.timeframe),
 n as (select symbol, timeframe, open_time, d as knn from p qualify row_number() over (partition by symbol, timeframe, open_time order by d) = 5)"""
SQL = {
    "scale_features": f"{SCALED} select symbol, timeframe, open_time, {rsql(Z, 5)} from k window s as (partition by symbol, timeframe)",
    "systematic_sample": f"with {BASE}, n as (select *, row_number() over (partition by symbol, timeframe order by open_time) - 1 as rn, count(*) over (partition by symbol, timeframe) as n from bars) "
    "select symbol, timeframe, open_time, round(close, 6) as close from n where rn % greatest(1, n // 300) = 0",
    "knn_distance": f"{KNN} select symbol, timeframe, open_time, round(knn, 5) as knn from n",
    "elbow_eps": f"""{KNN}, r as (select *, row_number() over (partition by symbol, timeframe order by knn) as rk from n),
      d as (select *, (knn - lag(knn) over w) - (lag(knn) over w - lag(knn, 2) over w) as dd from r window w as (partition by symbol, timeframe order by rk))
      select symbol, timeframe, round(greatest(0.3::double, least(3.0::double, arg_max(knn, dd))), 2) as eps from d where dd is not null group by 1, 2""",
}
