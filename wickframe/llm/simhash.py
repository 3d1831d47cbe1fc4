"""SimHash near-duplicates by a popcount embedding.

A fingerprint of 64 bits is mapped to the number of ones in each of its 16 segments of four
bits. Flipping a bit moves that point by one step along one axis, so the Manhattan distance of two points is at
most the Hamming distance of the fingerprints. Fingerprints within two bits therefore have points
within two steps, and such points share a grid cell that is at most one step from either: every
fingerprint enters its own cell and the up to 32 next to it, and only cells with two or
more fingerprints go on. There the bound is checked exactly, without comparing the
pairs of a cell: two fingerprints differ in at most two bits if and only if some 64-bit value
is at most one bit from both. Each fingerprint of a shared cell lists those values that lie
in the cell (at most four); whoever lists the same value is linked. At most 65 fingerprints can
list a value, so no group grows with the data, also where thousands of near copies meet.

Nulls, ties and edge cases: a null text is an empty one, with fingerprint 0, linked like any other;
equal fingerprints are one node; a null id never names a component (rows with a null id
take the component of their fingerprint, null if they are alone). Columns besides id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickframe.llm.common import cut, free_name, map_rows, table
from wickframe.llm.components import connected_components

SEGMENTS, BITS = 16, 4
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def simhash(text: bytes | None, words: int = 3, seed: int = 42) -> int:
    """Fingerprint of a text as a signed 64-bit number."""
    tokens = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    n = max(len(tokens) - words + 1, 1)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[min(words, len(tokens)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b], seed) for a, b in zip(starts, stops)])
    columns = np.frombuffer(raw, np.uint8).reshape(n, 8)
    ones = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", words: int = 3) -> DataFrame:
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col("text").cast("binary"))
    return map_rows(rows, "doc_id bigint, fp bigint", lambda: lambda row: [(row[0], simhash(row[1], words))])


def popcounts(fp: Column) -> Column:
    """Ones per segment of four bits, one hexadecimal digit each."""
    ones = F.lit(0x1111111111111111)
    a, b, c, d = (F.shiftrightunsigned(fp, j).bitwiseAND(ones) for j in range(BITS))
    return a + b + c + d


def grid_cells(fp: DataFrame) -> DataFrame:
    """Rows (fp, cell, step) for the cell of each fingerprint and its neighbours.

    ``step`` is 0 for the own cell, else one more than the segment, negative where it loses a one.
    """
    at = fp.withColumn("_p", popcounts(F.col("fp")))
    cells = [F.struct(F.col("_p").alias("cell"), F.lit(0).alias("step"))]
    for s in range(SEGMENTS):
        digit = F.shiftrightunsigned("_p", 4 * s).bitwiseAND(F.lit(15))
        one = 1 << (4 * s)
        cells.append(F.when(digit < BITS, F.struct((F.col("_p") + F.lit(one)).alias("cell"), F.lit(s + 1).alias("step"))))
        cells.append(F.when(digit > 0, F.struct((F.col("_p") - F.lit(one)).alias("cell"), F.lit(-s - 1).alias("step"))))
    return at.select("fp", F.inline(F.array_compact(F.array(*cells))))


def links(fp: DataFrame) -> DataFrame:
    """Linked fingerprints (f, g), differing in one or two bits: a subset with the same components."""
    cells = grid_cells(fp.select("fp").distinct())
    shared = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("cell")
    near = cells.join(shared, "cell", "left_semi")
    bit = [F.expr(f"shiftleft(1L, (abs(step) - 1) * {BITS} + {j})") for j in range(BITS)]
    middles = [F.when(F.col("step") == 0, F.col("fp"))]
    for b in bit:
        gains = F.col("fp").bitwiseAND(b) == 0
        middles.append(F.when((F.col("step") > 0) & gains | (F.col("step") < 0) & ~gains, F.col("fp").bitwiseXOR(b)))
    met = near.select("fp", F.explode(F.array_compact(F.array(*middles))).alias("_m"))
    groups = met.groupBy("_m").agg(F.min("fp").alias("g"), F.collect_list("fp").alias("_f")).filter(F.size("_f") > 1)
    pairs = groups.select(F.explode("_f").alias("f"), "g").filter("f <> g").distinct()
    return pairs.filter(F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= 2)


def component_of(fp: DataFrame) -> DataFrame:
    """(fp, component_id) for a table (doc_id, fp, ..); the id is null where all ids of a component are."""
    nodes = fp.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    named = nodes.filter("rep is not null")
    edges = (
        links(named)
        .join(named.select(F.col("fp").alias("f"), F.col("rep").alias("a")), "f")
        .join(named.select(F.col("fp").alias("g"), F.col("rep").alias("b")), "g")
        .select("a", "b")
    )
    roots = connected_components(edges)
    return nodes.join(roots, nodes.rep == roots.node, "left").select("fp", F.coalesce("root", "rep").alias("component_id"))


def simhash_components(docs: DataFrame, id_column: str = "doc_id", words: int = 3) -> DataFrame:
    """doc_id, fp and component_id (smallest id reachable over links of at most two bits), a row per document."""
    fp = cut(fingerprints(docs, id_column, words))
    return fp.join(component_of(fp), "fp").select("doc_id", "fp", "component_id")


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    out = simhash_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest id (of equal ids, the smallest content hash).

    Documents without an id are grouped by equal fingerprints only; repeated rows leave one; further columns may
    have any name. Texts are shuffled once.
    """
    key = free_name(docs, "_key")
    keyed = docs.withColumn(key, F.xxhash64(*docs.columns))
    rows = keyed.select(F.col("doc_id").cast("bigint"), F.col(key), F.col("text").cast("binary"))
    schema = "doc_id bigint, _key bigint, fp bigint"
    fp = cut(map_rows(rows, schema, lambda: lambda row: [(row[0], row[1], simhash(row[2]))]))
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_key")).alias("_w")
    winners = fp.join(component_of(fp), "fp").groupBy(group.alias("_g")).agg(first)
    winners = winners.select(F.col("_w.doc_id").alias("_id"), F.col("_w._key").alias("_k"))
    same = keyed.doc_id.cast("bigint").eqNullSafe(winners["_id"]) & (keyed[key] == winners["_k"])
    return keyed.join(winners, same, "left_semi").dropDuplicates(["doc_id", key]).select(*docs.columns)
