"""Near-duplicate vectors by a tiled comparison in PCA order.

Equal vectors of a label are one class, and classes are numbered, so an id may come with several vectors
or labels. Vectors of a label are unit vectors in double precision, turned into the
axes of a principal component analysis (fitted on a bounded sample; any rotation keeps cosines, so the
sample only decides how early comparisons stop). Since cosine c means a distance of sqrt(2 - 2c), linked
vectors lie in equal or adjacent cells of a grid over the two leading axes. Cells are dealt into tiles
of about ``TILE`` vectors, and tiles of adjacent cells are compared: the products of the leading
dimensions come first, the rest is bounded by the product of the suffix norms, and rows, columns and pairs that
cannot reach the threshold are dropped before the next dimensions are added. What is left is decided
by the full product of the vectors as given. A comparison returns counts and a spanning forest, never
pairs, so thousands of near copies make no more rows than they have vectors.

Nulls, ties and edge cases: vectors that are null, zero, empty or hold null or non-finite components, and rows with a
null label or id, link with nothing; vectors of different lengths are not compared; a label may have any
type that can be written as text; of rows with equal ids each counts, and each has the links and the component of its
own vector; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.common import arrow_schema, cut, table
from wickframe.llm.components import connected_components

THRESHOLD = 0.93
TILE = 512
STEPS = (8, 24)  # dimensions after which the bound is checked
SAMPLE = 4_096
SLACK = 1e-9  # for rounding of the bound


def principal_axes(vectors: np.ndarray) -> np.ndarray:
    """Orthogonal axes of unit vectors (rows), the largest variance first."""
    _, axes = np.linalg.eigh(np.cov(vectors, rowvar=False)) if len(vectors) > 1 else (0, np.eye(vectors.shape[1]))
    return axes[:, ::-1]


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    return v / np.sqrt((v * v).sum(1))[:, None]


def linked(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, steps=STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of unit vectors with cosine >= threshold."""
    ra, rb = a @ axes, b @ axes
    rows, cols = np.arange(len(a)), np.arange(len(b))
    done, total = 0, np.zeros((len(a), len(b)))
    alive = np.ones_like(total, bool)
    for stop in [s for s in steps if s < a.shape[1]]:
        total += ra[rows, done:stop] @ rb[cols, done:stop].T
        rest_a = np.sqrt(np.maximum(1 - (ra[rows, :stop] ** 2).sum(1), 0))
        rest_b = np.sqrt(np.maximum(1 - (rb[cols, :stop] ** 2).sum(1), 0))
        alive = total + rest_a[:, None] * rest_b[None] >= threshold - SLACK
        keep_r, keep_c = alive.any(1), alive.any(0)
        if not keep_r.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows, cols = rows[keep_r], cols[keep_c]
        total, alive, done = total[np.ix_(keep_r, keep_c)], alive[np.ix_(keep_r, keep_c)], stop
    i, j = np.nonzero(alive)
    i, j = rows[i], cols[j]
    if 8 * len(i) < len(rows) * len(cols):
        parts = [np.einsum("pd,pd->p", a[i[k : k + 65_536]], b[j[k : k + 65_536]]) for k in range(0, len(i), 65_536)]
        cosine = np.concatenate(parts) if parts else np.zeros(0)
    else:
        cosine = (a @ b.T)[i, j]
    hit = cosine >= threshold
    return i[hit], j[hit]


def forest(i: np.ndarray, j: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray) -> list[tuple[int, int]]:
    """(id, smallest id of its component) for the linked vectors of two tiles."""
    la, lb = a_ids.copy(), b_ids.copy()
    while True:
        old = la.copy(), lb.copy()
        np.minimum.at(lb, j, la[i])
        np.minimum.at(la, i, lb[j])
        if np.array_equal(old[0], la) and np.array_equal(old[1], lb):
            break
    return [*zip(a_ids[np.unique(i)].tolist(), la[np.unique(i)].tolist()), *zip(b_ids[np.unique(j)].tolist(), lb[np.unique(j)].tolist())]


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("v"), "label")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(sound, F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("ok", usable)
    classes = rows.filter("ok").groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = cut(classes.withColumn("rep", F.monotonically_increasing_id()))  # numbers are fixed once they are written

    seen: dict[int, list] = {}
    for r in classes.orderBy(F.xxhash64("least"), "least").limit(sample).select("v").collect():
        seen.setdefault(len(r["v"]), []).append(r["v"])
    axes = {d: principal_axes(unit(np.array(x))) for d, x in seen.items()}
    width = float(np.sqrt(max(2 - 2 * threshold, 0))) + SLACK

    def turn(d: int) -> np.ndarray:
        return axes.get(d, np.eye(d))

    place_schema = "label string, dim int, x int, y int, rep bigint, n bigint, v array<double>"
    place_fields = arrow_schema(place_schema)

    def place(batches):
        for batch in batches:
            out = []
            for label, v, rep, n in zip(*[c.to_pylist() for c in batch.columns]):
                u = unit(np.array([v]))
                at = np.floor((u @ turn(len(v)))[0, :2] / width).astype(int).tolist() + [0]
                out.append((label, len(v), at[0], at[1], rep, n, v))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), place_fields)], schema=place_fields)

    cell = ["label", "dim", "x", "y"]
    label_text = F.hex("label") if dict(classes.dtypes)["label"] == "binary" else F.col("label").cast("string")
    placed = cut(classes.select(label_text.alias("label"), "v", "rep", "n").mapInArrow(place, place_schema))
    sizes = placed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("k"))
    dealt = placed.join(sizes, cell).withColumn("t", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
    tiles = cut(dealt.groupBy(*cell, "t").agg(F.collect_list(F.struct("rep", "n", "v")).alias("m")))  # about `tile` each

    ids = tiles.select(*cell, "t")
    around = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    near = ids.select(*cell, "t", F.inline(around)).select(
        "label", "dim", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("t").alias("at"),
        (F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y"),
    )
    order = F.struct("ax", "ay", "at") <= F.struct("x", "y", "t")
    pairs = near.join(ids, cell).filter(order)
    first = tiles.select("label", "dim", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("t").alias("at"), F.col("m").alias("a"))
    both = pairs.join(first, ["label", "dim", "ax", "ay", "at"]).join(tiles.withColumnRenamed("m", "b"), [*cell, "t"])
    same = (F.col("ax") == F.col("x")) & (F.col("ay") == F.col("y")) & (F.col("at") == F.col("t"))
    found_schema = "rep bigint, links bigint, root bigint"
    found_fields = arrow_schema(found_schema)

    def members(cell_rows):
        kinds = cell_rows.values.flatten()
        ids = kinds[0].to_numpy(zero_copy_only=False)
        n = kinds[1].to_numpy(zero_copy_only=False)
        return ids, n, unit(kinds[2].flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1))

    def compare(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                is_same = batch.column(0)[row].as_py()
                a_ids, a_n, a = members(batch.column(1)[row])
                b_ids, b_n, b = (a_ids, a_n, a) if is_same else members(batch.column(2)[row])
                i, j = linked(a, b, turn(a.shape[1]), threshold)
                if is_same:
                    i, j = i[i != j], j[i != j]
                if not len(i):
                    continue
                counts = {}
                for ids, other, at, to in ((a_ids, b_n, i, j),) if is_same else ((a_ids, b_n, i, j), (b_ids, a_n, j, i)):
                    total = np.bincount(at, other[to], len(ids)).astype(np.int64)
                    counts.update((int(ids[k]), int(total[k])) for k in np.flatnonzero(total))
                roots = dict(forest(i, j, a_ids, b_ids))
                out = [(k, c, roots[k]) for k, c in counts.items()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), found_fields)], schema=found_fields)

    found = cut(both.select(same.alias("same"), "a", "b").mapInArrow(compare, found_schema))
    roots = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    least = classes.select("rep", "least").join(roots, F.col("rep") == roots.node).groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(links, "rep", "left").join(roots, F.col("rep") == roots.node, "left").join(least, "root", "left")
    named = named.select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")
    )
    good = rows.filter("ok").join(named, ["label", "v"]).select("vec_id", "n_links", "component_id")
    bad = rows.filter("not ok").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op1_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


SQL = {
    "op1_embedding_dedup": f"""
 with recursive e as (select vec_id, embedding::double[] as v, label from embeddings where vec_id is not null and label is not null and embedding is not null),
 g as (select *, sqrt(list_sum(list_transform(v, lambda x: x * x))) as norm from e
       where len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0),
 l as (select a.vec_id as a, b.vec_id as b from g a join g b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
       where list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {THRESHOLD}),
 r as (select vec_id, vec_id as root from embeddings union select l.b, r.root from r join l on l.a = r.vec_id)
 select vec_id, (select count(*) from l where l.a = vec_id) as n_links, min(root) as component_id, vec_id = min(root) as kept from r group by vec_id"""
}
