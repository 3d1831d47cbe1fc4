"""Exact quantiles per group, also for groups that do not fit into one task.

A radix histogram over the order-preserving bits of the double. Three rounds count values by the first 22, 43 and all 64
bits; after each the bins that hold a wanted rank are known, and the next round counts only values inside them. So the result is
exact for any distribution, all groups and ranks share one exchange of partial counts a round, no value but the wanted ones is
ranked or moved, and the work of a task is bounded by the bins of one group: 2^22 in the first round and 2^21 in
each bin of the later ones, whatever the number of rows. Where no wanted bin of the first round holds more than 2^21 values, its values
are within that bound themselves, and the second round counts by all bits.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickframe.plans.lineage import written

SHIFTS = (42, 21, 0)  # bits that a round leaves out
BIN_VALUES = 1 << 21
MANTISSA = 1 << 52
LEAST_NORMAL = 2.0**-1022
LEAST = 2.0**-1074


def order_bits(v: Column) -> Column:
    """A long that orders like the double: the bits of its magnitude, negated below zero. Null stays null, NaN comes last."""
    a = F.abs(v)
    two = F.lit(2.0)
    guess = F.greatest(F.floor(F.log2(a)), F.lit(-1022))
    ratio = a / F.pow(two, guess.cast("double"))
    # the logarithm may be off by one next to a power of two
    e = guess + F.when(ratio >= 2, 1).when(ratio < 1, -1).otherwise(0)
    mantissa = ((a / F.pow(two, e.cast("double")) - 1) * float(MANTISSA)).cast("bigint")
    magnitude = (
        F.when(F.isnan(v), F.lit(2047 * MANTISSA + 1))
        .when(a == float("inf"), F.lit(2047 * MANTISSA))
        .when(a < LEAST_NORMAL, (a / LEAST).cast("bigint"))
        .otherwise((e + 1023) * F.lit(MANTISSA) + mantissa)
    )
    return F.when((v < 0) & ~F.isnan(v), -magnitude).otherwise(F.when(v.isNotNull(), magnitude))


def from_order_bits(k: Column) -> Column:
    """The double that ``order_bits`` maps to ``k``."""
    m = F.abs(k)
    e, fraction = F.shiftright(m, 52), m.bitwiseAND(F.lit(MANTISSA - 1)).cast("double")
    a = (
        F.when(m > 2047 * MANTISSA, F.lit(float("nan")))
        .when(e == 2047, F.lit(float("inf")))
        .when(e == 0, fraction * LEAST)
        .otherwise((fraction / float(MANTISSA) + 1) * F.pow(F.lit(2.0), (e - 1023).cast("double")))
    )
    return F.when(k < 0, -a).otherwise(a)


def _join(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join that also matches null keys."""
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    rest = [F.col(f"b.{c}") for c in b.columns if c not in keys]
    return a.alias("a").join(b.alias("b"), on).select("a.*", *rest)


def _holding_ranks(bins: DataFrame, within: list[str], ranks: Column, each: list[Column] | None = None) -> DataFrame:
    """Bins (``_bin``, ``_c`` values) that hold a wanted rank, with those ranks counted from the start of the bin.

    ``each`` are the members of ``ranks`` where they are the same in all bins; they sort most bins out cheaply.
    """
    order = Window.partitionBy(*within).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = bins.withColumn("_end", F.sum("_c").over(order)).withColumn("_start", F.col("_end") - F.col("_c"))

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_start")) & (rank < F.col("_end"))

    if each:
        placed = placed.filter(reduce(or_, map(holds, each)))
    here = F.transform(
        F.filter(ranks, lambda r: holds(r["rank"])),
        lambda r: F.struct(r["of"].alias("of"), (r["rank"] - F.col("_start")).alias("rank")),
    )
    return placed.withColumn("_ranks", here).filter(F.size("_ranks") > 0).drop("_end", "_start")


def exact_quantiles(df: DataFrame, keys, value: str | Column, probs: dict[str, float], stored: bool = False) -> DataFrame:
    """One row per group: row count ``n`` and the linearly interpolated quantiles named in ``probs``.

    Null values do not count; groups without a value have no row. The values are written to the shared folder first and read
    two or three times from there; ``stored`` says that ``df`` is a stored table itself, which is then read instead. All rounds
    but the last run when the function is called, so the planner knows the size of what the next one joins.
    """
    keys = list(keys)
    ps = [float(p) for p in probs.values()]
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    source = df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull()).select(*keys, order_bits(F.col("_v")).alias("_k"))
    x = source if stored else written(source)

    def counts(rows: DataFrame, shift: int, by: list[str], carried: list[str]) -> DataFrame:
        bin_ = F.shiftright("_k", shift) if shift else F.col("_k")
        return rows.groupBy(*by, bin_.alias("_bin")).agg(F.count(F.lit(1)).alias("_c"), *[F.first(c).alias(c) for c in carried])

    last = F.col("n") - 1
    wanted = []
    for i, p in enumerate(ps):
        low = F.floor(F.lit(p) * last)
        wanted += [(2 * i, low), (2 * i + 1, F.least(low + 1, last))]
    ranks = F.array(*[F.struct(F.lit(of).alias("of"), r.cast("bigint").alias("rank")) for of, r in wanted])
    total = F.sum("_c").over(Window.partitionBy(*keys))
    found = written(_holding_ranks(counts(x, SHIFTS[0], keys, []).withColumn("n", total), keys, ranks, [r for _, r in wanted]))
    fullest = found.agg(F.max("_c")).first()[0] or 0
    shifts = SHIFTS if fullest > BIN_VALUES else (SHIFTS[0], SHIFTS[-1])
    for before, shift in zip(shifts, shifts[1:]):
        inside = x.withColumn("_in", F.shiftright("_k", before))
        rows = _join(inside, found.drop("_c").withColumnsRenamed({"_bin": "_in", "_ranks": "_wanted"}), [*keys, "_in"])
        bins = counts(rows, shift, [*keys, "_in"], ["n", "_wanted"])
        found = _holding_ranks(bins, [*keys, "_in"], F.col("_wanted")).drop("_in", "_wanted")
        if shift:
            found = written(found)
    at = found.select(*keys, "n", from_order_bits(F.col("_bin")).alias("_x"), F.explode("_ranks.of").alias("_of"))
    ends = at.groupBy(*keys).agg(
        F.first("n").alias("n"), *[F.max(F.when(F.col("_of") == of, F.col("_x"))).alias(f"_x{of}") for of, _ in wanted]
    )
    fraction = [F.lit(p) * last - F.floor(F.lit(p) * last) for p in ps]
    between = [F.col(f"_x{2 * i}") + (F.col(f"_x{2 * i + 1}") - F.col(f"_x{2 * i}")) * f for i, f in enumerate(fraction)]
    return ends.select(*keys, "n", *[q.alias(c) for c, q in zip(probs, between)])
