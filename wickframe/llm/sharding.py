"""Sharding by extendible hashing.

A document's key is hashed to 60 bits. A shard is a prefix of those bits; it starts as the empty one and is
split on one more bit while its documents exceed the byte limit, so only oversized shards split. A key whose rows
alone exceed the limit is split further in the same way on 60 bits of a hash of the content. All is
counted in steps of ``STEP`` bits: one aggregate gives the bytes of each prefix at the end of a step, their
sums give every level in between, and only documents whose prefix is still too large enter the next
step. The directory (prefix, depth, bytes) and the assignment are plain tables; no Python runs on executors.

A shard is called 'depth-prefix', and 'depth-key.prefix' (depth beyond 60) where it is part of one key.

Nulls, ties and edge cases: a null key hashes as an empty string; a null text has 0 bytes and the content of an empty one; rows with equal
keys and equal content cannot be told apart, so a shard of such rows is not split even beyond the limit (``fits`` is false), nor is
a single row; an empty table has no shards. Columns besides key and text are ignored; a key called like a column of the
result comes out as ``<name>_key``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickframe.llm.common import cut, table

LIMIT = 64 * 1024 * 1024
QUERY_LIMIT = 128 * 1024  # of the registered query: the smallest tables too are dozens of shards
BITS = 60
STEP = 10
RESULT = ("h", "bytes", "shard", "depth", "shard_bytes", "fits")


def hash_bits(value: Column) -> Column:
    """First 60 bits of the md5 of the value as text."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def split_until_fit(pending: DataFrame, within: list[str], bits: str, limit: int) -> DataFrame:
    """Rows with ``s`` (depth, prefix, shard_bytes, one): the shortest prefix of ``bits`` inside ``within`` whose rows fit or cannot be split."""
    done, low = [], 0
    while True:
        high = min(low + STEP, BITS)
        at = F.shiftright(bits, BITS - high)
        cells = pending.groupBy(*within, at.alias("cell")).agg(F.sum("bytes").alias("b"), F.min(bits).alias("h0"), F.max(bits).alias("h1"))
        levels = cells.select("*", F.explode(F.array(*[F.lit(d) for d in range(low, high + 1)])).alias("depth"))
        levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
        sums = levels.groupBy(*within, "depth", "prefix").agg(F.sum("b").alias("shard_bytes"), (F.min("h0") == F.max("h1")).alias("one"))
        whole = sums.filter((F.col("shard_bytes") <= limit) | F.col("one"))
        spread = levels.select(*within, "cell", "depth", "prefix").join(whole, [*within, "depth", "prefix"])
        chosen = spread.groupBy(*within, "cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "one")).alias("s"))
        placed = cut(pending.withColumn("cell", at).join(chosen, [*within, "cell"], "left").select(*pending.columns, "s"))
        done.append(placed.filter("s is not null"))
        pending = placed.filter("s is null").drop("s")
        if high == BITS or pending.isEmpty():
            return reduce(DataFrame.unionByName, done)
        low = high + 1


def assign_shards(docs: DataFrame, key: str = "doc_id", size: Column | None = None, limit: int = LIMIT, content: Column | None = None) -> DataFrame:
    """Key, hash, bytes, shard, depth, bytes of the shard and whether it fits the limit."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) if size is None else size
    content = F.col("text") if content is None else content
    rows = docs.select(F.col(key).alias("key"), hash_bits(F.col(key)).alias("h"), size.cast("bigint").alias("bytes"), hash_bits(content).alias("c"))
    by_key = split_until_fit(cut(rows), [], "h", limit)
    large = F.col("s.one") & (F.col("s.shard_bytes") > limit)
    name = F.concat_ws("-", F.col("s.depth"), F.col("s.prefix"))
    out = by_key.filter(~large).select("key", "h", "bytes", name.alias("shard"), "s.depth", "s.shard_bytes")
    parts = cut(by_key.filter(large).drop("s"))
    if not parts.isEmpty():
        depth = F.col("s.depth") + BITS
        name = F.concat(depth.cast("string"), F.lit("-"), F.col("h").cast("string"), F.lit("."), F.col("s.prefix").cast("string"))
        by_content = split_until_fit(parts, ["h"], "c", limit)
        out = out.unionByName(by_content.select("key", "h", "bytes", name.alias("shard"), depth.alias("depth"), "s.shard_bytes"))
    named = out.withColumn("fits", F.col("shard_bytes") <= limit)
    return named.withColumnRenamed("key", f"{key}_key" if key.lower() in RESULT else key)


def directory(assigned: DataFrame) -> DataFrame:
    """One row per shard: depth, bytes and documents."""
    return assigned.groupBy("shard").agg(
        F.first("depth").alias("depth"), F.first("shard_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("n_docs"), F.first("fits").alias("fits")
    )


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    out = assign_shards(table(spark, sf_dir, "documents"), limit=QUERY_LIMIT)
    return out.select("doc_id", "bytes", "shard", F.col("depth").cast("bigint").alias("depth"), "shard_bytes", "fits")


def sharding_sql(limit: int = QUERY_LIMIT) -> str:
    def bits(text: str) -> str:
        return f"('0x' || substr(md5(coalesce({text}, '')), 1, 15))::bigint"

    return f"""
 with k as (select doc_id, strlen(coalesce(text, ''))::bigint as bytes, {bits("doc_id::varchar")} as h, {bits("text")} as c from documents),
      v as (select d, h >> (60 - d) as p, sum(bytes)::bigint as b, min(h) = max(h) as one from k, range(0, 61) r(d) group by all),
      w as (select * from v where b <= {limit} or one),
      x as (select k.h, min(w.d) as d from (select distinct h from k) k join w on w.p = k.h >> (60 - w.d) group by 1),
      f as (select k.*, x.d, w.p, w.b from k join x using (h) join w on w.d = x.d and w.p = k.h >> (60 - x.d)),
      l as (select doc_id, bytes, h, c from f where b > {limit}),
      v2 as (select h, d, c >> (60 - d) as p, sum(bytes)::bigint as b, min(c) = max(c) as one from l, range(0, 61) r(d) group by all),
      w2 as (select * from v2 where b <= {limit} or one),
      x2 as (select k.h, k.c, min(w2.d) as d from (select distinct h, c from l) k join w2 on w2.h = k.h and w2.p = k.c >> (60 - w2.d) group by 1, 2)
 select doc_id, bytes, d || '-' || p as shard, d::bigint as depth, b as shard_bytes, true as fits from f where b <= {limit}
 union all
 select l.doc_id, l.bytes, (60 + x2.d) || '-' || l.h || '.' || w2.p, 60 + x2.d, w2.b, w2.b <= {limit}
 from l join x2 using (h, c) join w2 on w2.h = l.h and w2.d = x2.d and w2.p = l.c >> (60 - x2.d)"""


SQL = {"op9_sharding": sharding_sql()}
