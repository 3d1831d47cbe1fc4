"""Document fingerprints by winnowing.

Every run of ``k`` code points is hashed by a rolling polynomial modulo 2^64 (as differences of
running sums). Of each window of ``w`` hashes the smallest is chosen, the rightmost of equal ones,
and kept with its position. Two texts that share at least ``k + w - 1`` code points in a row therefore
share a chosen hash, and the positions tell where.

Nulls, ties and edge cases: a null text is an empty one; an empty text has no hashes; a text shorter than ``k``
is one run; with fewer than ``w`` hashes there is one window. The likeness of two empty fingerprints is 1,
of an empty and another one 0. Null ids sort first; rows of equal ids follow each other by text.
Columns besides id and text are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.common import arrow_schema, map_rows, table

K, W = 16, 32
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
MIX = np.uint64(0xD6E8FEB86659FD93)
LOWEST = -(2**63)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i < n."""
    up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def gram_hashes(text: str, k: int = K) -> np.ndarray:
    """32-bit hash of every run of ``k`` code points."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(c):
        return np.zeros(0, np.uint64)
    k = min(k, len(c))
    up, down = _powers(1 << max(10, int(len(c)).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((c + np.uint64(1)) * down[: len(c)])])
    h = (sums[k:] - sums[:-k]) * up[: len(c) - k + 1]  # now the same wherever the run stands
    h ^= h >> np.uint64(32)
    h *= MIX
    h ^= h >> np.uint64(32)
    h *= MIX
    return h >> np.uint64(32)


def winnow(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their positions, in text order."""
    h = gram_hashes(text, k)
    n = len(h)
    if not n:
        return h, h
    w = min(w, n)
    low = np.uint64(0xFFFFFFFF)
    keys = h << np.uint64(32) | (low - np.arange(n, dtype=np.uint64))  # rightmost of equal hashes is smallest
    blocks = np.full(-(-n // w) * w, ~np.uint64(0))
    blocks[:n] = keys
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - w + 1], ahead[w - 1 : n])
    chosen = least[np.concatenate([[True], least[1:] != least[:-1]])]
    return chosen >> np.uint64(32), low - (chosen & low)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share of the different hashes of two fingerprints (sorted, unique)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Short name of a fingerprint: equal hashes at equal positions have equal names."""
    return hashlib.blake2b(np.stack([hashes, positions]).astype("<u4").tobytes(), digest_size=16).hexdigest()


def fingerprint_documents(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """doc_id with the chosen hashes and positions."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")

    def make():
        return lambda row: [(row[0], *(x.astype(np.int64) for x in winnow(row[1] or "", k, w)))]

    return map_rows(rows, "doc_id bigint, hashes array<bigint>, positions array<bigint>", make)


def with_next(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """(part, copy, key, doc_id, text), sorted so that each document is followed by the next one by id.

    Ids are cut into ranges at quantiles that are ids themselves. A range also gets a copy of the first
    document of the next range (the last one: of the first). Texts are shuffled once.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST))
    rows = docs.select(key.alias("key"), F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    found = rows.agg(F.min("key"), F.percentile_approx("key", [i / n for i in range(1, n)] or [0.5], max(10_000, 20 * n))).first()
    bounds = sorted({found[0], *(found[1] or [])}) if found[0] is not None else [0]  # one id per partition
    last = len(bounds) - 1

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(), side="right") - 1).astype("int32")

    @F.pandas_udf("boolean")
    def opens(key: pd.Series) -> pd.Series:
        return pd.Series(np.isin(key.to_numpy(), bounds))

    placed = rows.withColumns({"part": part_of("key"), "_opens": opens("key")})
    before = F.when(F.col("part") == 0, last).otherwise(F.col("part") - 1)
    places = F.array(
        F.struct(F.col("part").alias("part"), F.lit(0).alias("copy")),
        F.when(F.col("_opens"), F.struct(before.alias("part"), F.lit(1).alias("copy"))),
    )
    spread = placed.select("key", "doc_id", "text", F.inline(F.array_compact(places)))
    spread = spread.repartition(max(len(bounds), 1), "part")
    return spread.sortWithinPartitions("part", "copy", "key", "text").select("part", "copy", "key", "doc_id", "text")


def compare_edits(docs: DataFrame, k: int = K, w: int = W, rows: int = 64) -> DataFrame:
    """Each document against its edited text and against the next document."""
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_hashes bigint"
    )
    fields = arrow_schema(schema)

    def compared(this, following):
        doc_id, text, (hashes, at, unique) = this
        half = len(text) // 2
        edited = text[: len(text) - half] + following[1][:half]
        e_hashes, e_at = winnow(edited, k, w)
        return (
            doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), digest(hashes, at),
            digest(e_hashes, e_at), likeness(unique, np.unique(e_hashes)), likeness(unique, following[2][2]), len(hashes),
        )

    def run(batches):
        waiting, part = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                out = []
                columns = [c.to_pylist() for c in batch.slice(start, rows).columns]
                for p, copy, _, doc_id, text in zip(*columns):
                    if copy and waiting is None:
                        continue  # a further row with the id that opens the next range
                    hashes, at = winnow(text, k, w)
                    this = (doc_id, text, (hashes, at, np.unique(hashes)))
                    if waiting is not None and p == part:
                        out.append(compared(waiting, this))
                    waiting, part = (None, None) if copy else (this, p)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), fields)], schema=fields)

    return with_next(docs).mapInArrow(run, schema)


def op3_winnowing(spark, sf_dir: str) -> DataFrame:
    return compare_edits(table(spark, sf_dir, "documents"))
