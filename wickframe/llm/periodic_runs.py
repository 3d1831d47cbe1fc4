"""Periodic runs of words by recompression.

The word sequences of some documents, each closed by a mark of its own, become one sequence, and that a run-length
grammar: rounds in turn replace every block of an equal symbol by a symbol for (symbol, count), and every pair of
a left and a right symbol, as a hash of symbol and round deals them, by a symbol for the pair. Equal stretches get equal
symbols but for a few at their ends, so the grammar tells how far two positions agree (forwards or backwards) by
walking both derivations side by side and skipping equal symbols, whole powers at once; no suffix array is built.

A run of period q and length >= need = max(min_length, min_exponent * q) agrees with itself q words on over need - q words. So
positions at steps of need - q - k + 1 (the harmonic grid of q) hold one in every such run where k words in a row agree. The grid
positions that pass this test are candidates; the grammar extends each exactly to both sides. Periods are tried in
ascending order, and a candidate inside a found run whose period divides q is no new run: q is not its smallest period there.

Nulls, ties and edge cases: a null or empty text has no words and no runs. Words are what lies between the bytes 0x20 and
0x09 to 0x0D, compared byte by byte. Runs that overlap are all kept. Repeated rows are treated one by one, a null doc_id stays
null, columns besides doc_id and text are ignored, and an empty table gives an empty one. Documents are joined up to about a
million words; a longer one stands alone, so a task holds one long text at most.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.common import arrow_schema, give_back, table

MIN_LENGTH, MIN_EXPONENT = 6, 4
BYTES = 4 << 20  # of text whose documents share a grammar
TOP = 256  # symbols at which the rounds end
AGREE = 8  # words in a row that a candidate has to agree in, at most
SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


class Grammar:
    """Run-length grammar of an integer sequence with longest common extensions."""

    def __init__(self, sequence: np.ndarray, top: int = TOP):
        seq = sequence.astype(np.int64)
        terminals = int(seq.max(initial=-1)) + 1
        # rule of a symbol: first and second part, or first part and times; no rule for terminals
        first, second, times = [np.full(terminals, -1)], [np.full(terminals, -1)], [np.zeros(terminals, np.int64)]
        sizes = np.ones(terminals, np.int64)
        turn = 0
        while len(seq) > top:
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            counts = np.diff(np.append(starts, len(seq)))
            seq = seq[starts]
            blocks = np.flatnonzero(counts > 1)
            if len(blocks):
                longest = int(counts.max()) + 1
                rules, names = np.unique(seq[blocks] * longest + counts[blocks], return_inverse=True)
                seq[blocks] = len(sizes) + names
                base, power = rules // longest, rules % longest
                first.append(base), second.append(np.full(len(base), -1)), times.append(power)
                sizes = np.append(sizes, sizes[base] * power)
            left = self._left(seq, turn)
            turn += 1
            pairs = [np.flatnonzero(left[:-1] & ~left[1:]), np.flatnonzero(~left[:-1] & left[1:])]
            at = max(pairs, key=len)
            if len(at):
                total = len(sizes)
                rules, names = np.unique(seq[at] * total + seq[at + 1], return_inverse=True)
                seq[at] = total + names
                seq = np.delete(seq, at + 1)
                a, b = rules // total, rules % total
                first.append(a), second.append(b), times.append(np.zeros(len(a), np.int64))
                sizes = np.append(sizes, sizes[a] + sizes[b])
        self._rules = first, second, times, sizes
        self._seq = seq
        self._ready = False

    @staticmethod
    def _left(symbols: np.ndarray, turn: int) -> np.ndarray:
        x = (symbols.astype(np.uint64) + np.uint64(turn + 1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(63)) == 1

    def _prepare(self) -> None:
        first, second, times, sizes = self._rules
        self.first, self.second, self.times = (np.concatenate(p).tolist() for p in (first, second, times))
        self.size = sizes.tolist()
        self.top = self._seq.tolist()
        self.starts = (np.cumsum(sizes[self._seq]) - sizes[self._seq]).tolist()
        self._ready = True

    def _cursor(self, position: int, near: list[int], far: list[int], backwards: bool) -> tuple[list, int]:
        """Symbols with counts from a position on (the last is the next one) and the next top symbol."""
        if backwards:
            if position <= 0:
                return [], -1
            at = bisect_right(self.starts, position - 1) - 1
            skip = self.starts[at] + self.size[self.top[at]] - position
        else:
            at = bisect_right(self.starts, position) - 1
            skip = position - self.starts[at]
        stack, s, size, times = [], self.top[at], self.size, self.times
        while skip:
            if times[s]:
                a = self.first[s]
                gone, skip = divmod(skip, size[a])
                left = times[s] - gone - bool(skip)
                if left:
                    stack.append((a, left))
                s = a
                if not skip:
                    return stack, at + (-1 if backwards else 1)
            elif skip < size[near[s]]:
                stack.append((far[s], 1))
                s = near[s]
            else:
                skip -= size[near[s]]
                s = far[s]
        stack.append((s, 1))
        return stack, at + (-1 if backwards else 1)

    def agree(self, i: int, j: int, backwards: bool = False) -> int:
        """How many symbols from i and from j on are equal; backwards: how many that end before i and before j."""
        if not self._ready:
            self._prepare()
        near, far = (self.second, self.first) if backwards else (self.first, self.second)
        size, times, first, top = self.size, self.times, self.first, self.top
        step = -1 if backwards else 1
        one, p = self._cursor(i, near, far, backwards)
        other, r = self._cursor(j, near, far, backwards)
        n = 0
        while True:
            if not one:
                if not 0 <= p < len(top):
                    return n
                one.append((top[p], 1))
                p += step
            if not other:
                if not 0 <= r < len(top):
                    return n
                other.append((top[r], 1))
                r += step
            (x, c), (y, d) = one.pop(), other.pop()
            if x == y:
                m = min(c, d)
                n += m * size[x]
                if c > m:
                    one.append((x, c - m))
                elif d > m:
                    other.append((y, d - m))
                continue
            if size[x] >= size[y]:
                if size[x] == 1:
                    return n
                other.append((y, d))
                stack, s, c = one, x, c
            else:
                one.append((x, c))
                stack, s, c = other, y, d
            if c > 1:
                stack.append((s, c - 1))
            if times[s]:
                stack.append((first[s], times[s]))
            else:
                stack.append((far[s], 1))
                stack.append((near[s], 1))


def find_runs(sequence: np.ndarray, longest: int, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of all maximal runs in documents of at most ``longest`` words, closed by unique marks."""
    n = len(sequence)
    grammar = None
    found: list[tuple[int, int, int]] = []
    for q in range(1, longest // min_exponent + 1):
        need = max(min_length, min_exponent * q)
        k = min(AGREE, max((need - q) // 2, 1))
        at = np.arange(0, n - q - k + 1, need - q - k + 1)
        for t in range(k):
            at = at[sequence[at + t] == sequence[at + (t + q)]]
            if not len(at):
                break
        if not len(at):
            continue
        found_here = [(s, e) for s, e, p in found if q % p == 0 and e - s > q]
        if found_here:
            s, e = np.array(found_here).T
            inside = np.zeros(len(at) + 1, np.int64)
            lo, hi = np.searchsorted(at, s), np.searchsorted(at, e - q)
            np.add.at(inside, lo, 1)
            np.add.at(inside, np.maximum(hi, lo), -1)
            at = at[np.cumsum(inside)[:-1] == 0]
        end = 0
        for c in at.tolist():
            if c + q < end:
                continue  # in the run just found
            if grammar is None:
                grammar = Grammar(sequence)
            s, e = c - grammar.agree(c, c + q, backwards=True), c + q + grammar.agree(c, c + q)
            if e - s >= need:
                found.append((s, e, q))
                end = e
    return sorted(found)


def split_words(text: bytes) -> list[bytes]:
    return text.split()  # of bytes: at 0x20 and 0x09 to 0x0D


def _solve(docs: list[list[bytes]], min_length: int, min_exponent: int) -> list[tuple]:
    """n_words, runs and collapsed text of each document, all of them in one sequence."""
    names: dict[bytes, int] = {}
    marks = len(docs)
    parts, starts, at = [], [], 0
    for i, words in enumerate(docs):
        part = [names.setdefault(w, len(names) + marks) for w in words]
        part.append(i)
        starts.append(at)
        parts.append(np.array(part, np.int64))
        at += len(part)
    runs = find_runs(np.concatenate(parts), max(map(len, docs)), min_length, min_exponent)
    of = [[] for _ in docs]
    for s, e, q in runs:
        i = bisect_right(starts, s) - 1
        of[i].append((s - starts[i], e - s, q))
    out = []
    for words, mine in zip(docs, of):
        kept = words
        if mine:
            drop = np.zeros(len(words) + 1, np.int64)
            for s, length, q in mine:
                drop[s + q] += 1
                drop[s + length] -= 1
            kept = [w for w, d in zip(words, np.cumsum(drop).tolist()) if not d]
        rows = [{"start": s, "length": length, "period": q} for s, length, q in mine]
        out.append((len(words), rows, b" ".join(kept)))
    return out


def periodic_runs(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Per document its number of words, all its runs by start and period, and the text with every run cut to one period.

    A run is a stretch of words with smallest period q, at least ``min_length`` words and ``min_exponent`` periods long
    (at least 2), that no neighbouring word extends. ``edit(doc_id, words)`` may change the words before.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    fields = arrow_schema(SCHEMA)

    def solved(ids: list, words: list) -> pa.RecordBatch:
        rows = _solve(words, min_length, min_exponent)
        columns = [pa.array(ids, pa.int64()), *(pa.array(c) for c in ([r[0] for r in rows],))]
        runs = pa.array([r[1] for r in rows], fields.field("runs").type)
        texts = pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([*columns, runs, texts], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words, size = [], [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_py() or b""
                if ids and size + len(raw) > BYTES:
                    yield solved(ids, words)
                    ids, words, size = [], [], 0
                mine = split_words(raw)
                ids.append(i)
                words.append(edit(i, mine) if edit else mine)
                size += len(raw)
            if ids:
                yield solved(ids, words)
        give_back()

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(run, SCHEMA)


def make_periodic(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Repeat a stretch in one document of ten, as its id decides, so that long runs are there to be found; not without an id."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), edit=make_periodic)
    better = "a.length * b.period"
    worse = "b.length * a.period"
    best = F.expr(
        f"array_sort(runs, (a, b) -> CASE WHEN {better} > {worse} THEN -1 WHEN {better} < {worse} THEN 1"
        " WHEN a.start < b.start THEN -1 WHEN a.start > b.start THEN 1 WHEN a.period < b.period THEN -1 WHEN a.period > b.period THEN 1 ELSE 0 END)"
    )
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    lines = F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), "")
    out = found.withColumn("_best", F.get(best, F.lit(0)))
    return out.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
