"""Phrase collocations of a corpus by prefix-free parsing.

Every document is a sequence of words and breaks (where a piece ends). Wherever the hash of two neighbouring tokens is a
multiple of ``SPACING``, one chunk ends and the next begins, and a chunk runs on over the first words of the next one, as
many as the longest phrase has words besides its first. So equal passages give equal chunks wherever they stand; the different
chunks of a group are the dictionary, and how often each occurs is its parse frequency. Every phrase lies wholly inside the
chunk that owns its first word, so phrases are counted in different chunks only, each weighted by the frequency of its chunk, and
none in an overlap is counted twice.

Most phrases are rare. A first pass over the dictionary therefore counts 40-bit hashes of phrases: tasks add up equal phrases by
exact keys and send packed, sorted lists of hashes, dealt to so many ranges that each holds a bounded number at any size of the
corpus. The hashes that reach the least count are marked in a bit set of fixed size. A second pass counts the marked phrases by
their words. The bit set only saves shuffling: a hash that stands for several phrases, or a full set, lets more phrases into the second pass, whose
counts are exact, and never keeps one out.

Nulls, ties and edge cases: a null text is empty, a null group is ``und``; texts are lower-cased in A-Z only; texts without words and
empty tables give no rows; repeated rows count as often as they occur; phrases of equal score and count are ranked by
their bytes; columns besides the text and the group are ignored. Scores use 38-digit integers, exact for corpora of up to 10^15 words.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickframe.llm.common import arrow_schema, give_back, shared_folder, table

BREAK = b"."  # stands for all breaks; no word holds it
BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b".......... ")
LONGEST = 3  # words of a phrase
SPACING = 24  # tokens between two chunk borders, on average
DICTIONARY_BYTES = 24 << 20  # of chunks that a task adds up before it sends them
WINDOW = 1 << 21  # tokens whose phrases a task adds up before it sends them
HASH_BITS = 40
RANGE = 1 << 21  # phrases that a range of hashes holds, about, at most
MARK_BITS = 28  # the bit set holds 2^28 bits
MARK_PARTS = 256
SALTS = 16


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case, with a break where a piece ends."""
    return text.lower().translate(BREAKS).replace(BREAK, b" . ").split()


class _Hashes(dict):
    def __missing__(self, token: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        value = self[token] = xxhash.xxh64_intdigest(token)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(words: list[bytes], hashes: dict, spacing: int = SPACING) -> Iterator[bytes]:
    """Overlapping chunks of a token sequence; the last ``LONGEST - 1`` tokens of each belong to the next one."""
    if not words:
        return
    overlap = LONGEST - 1
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    borders = np.flatnonzero(_mix(h[:-1] * np.uint64(3) + h[1:]) % np.uint64(spacing) == 0).tolist()
    closed = [*words, *[BREAK] * overlap]
    start = 0
    for stop in [*borders, len(words)]:
        if stop > start:
            yield b" ".join(closed[start : stop + overlap])
            start = stop


def owned_words(chunk: bytes) -> int:
    own = chunk.rsplit(b" ", LONGEST - 1)[0]
    return own.count(b" ") + 1 - own.count(BREAK)


def parse(docs: DataFrame, text: str = "text", group: str = "lang") -> DataFrame:
    """The dictionary: different chunks of each group, how many words each owns, and its parse frequency."""
    schema = "grp string, chunk string, own bigint, freq bigint"
    fields = arrow_schema(schema)

    def rows(counts: dict) -> Iterator[pa.RecordBatch]:
        for grp, found in counts.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([grp] * len(found), pa.string()),
                    pa.array(list(found), pa.binary()).cast(pa.string()),
                    pa.array(list(map(owned_words, found)), pa.int64()),
                    pa.array(list(found.values()), pa.int64()),
                ],
                schema=fields,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, size = _Hashes(), defaultdict(dict), 0
        for batch in batches:
            for grp, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                mine = counts[grp]
                for c in chunks(tokens(raw.as_py() or b""), hashes):
                    if c in mine:
                        mine[c] += 1
                    else:
                        mine[c] = 1
                        size += len(c) + 100
                if size > DICTIONARY_BYTES:
                    yield from rows(counts)
                    counts.clear()
                    size = 0
        yield from rows(counts)
        del hashes, counts
        give_back()

    source = docs.select(
        F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("grp"), F.col(text).cast("string").cast("binary").alias("text")
    )
    # the tasks have added up their chunks already
    return source.mapInArrow(run, schema).groupBy("grp", "chunk", "own").agg(F.sum("freq").alias("freq"))


class _Window:
    """Tokens of many chunks of one group; adds up their phrases by exact keys."""

    def __init__(self):
        self.names: dict[bytes, int] = {BREAK: 0}
        self.ids: list[np.ndarray] = []
        self.freqs: list[int] = []
        self.length = 0

    def add(self, chunk: bytes, freq: int) -> None:
        names = self.names
        part = [names.setdefault(w, len(names)) for w in chunk.split(b" ")]
        self.ids.append(np.array(part, np.int64))
        self.freqs.append(freq)
        self.length += len(part)

    def phrases(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length the token ids of the different phrases (one row each) and their weighted counts."""
        sizes = np.array([len(p) for p in self.ids])
        ids = np.concatenate(self.ids)
        freq = np.repeat(np.array(self.freqs, np.int64), sizes)
        ends = np.cumsum(sizes)
        owned = np.ones(len(ids), bool)
        for t in range(1, LONGEST):
            owned[ends - t] = False
        base = len(self.names)
        if base ** LONGEST >= 1 << 63:
            raise OverflowError("a window has too many different words")
        at = np.flatnonzero(owned & (ids > 0))
        key = ids[at]
        for n in range(1, LONGEST + 1):
            if n > 1:
                more = ids[at + n - 1]
                at, key = at[more > 0], key[more > 0] * base + more[more > 0]
            if not len(at):
                return
            order = np.argsort(key)
            ordered = key[order]
            starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
            found = ordered[starts]
            rows = [found // base**t % base for t in range(n - 1, -1, -1)]
            yield np.stack(rows, axis=1), np.add.reduceat(freq[at][order], starts)

    def token_list(self) -> list[bytes]:
        return list(self.names)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Window]]:
    """Windows of bounded size over rows (grp, chunk, freq)."""
    windows: dict[str, _Window] = defaultdict(_Window)
    total = 0
    for batch in batches:
        for grp, chunk, freq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            window = windows[grp]
            before = window.length
            window.add(chunk, freq)
            total += window.length - before
            if total >= WINDOW or len(window.names) >= 1 << 20:
                yield from windows.items()
                windows.clear()
                total = 0
    yield from windows.items()


def _phrase_hashes(grp: str, rows: np.ndarray, token_hashes: np.ndarray) -> np.ndarray:
    """40-bit hashes of phrases of a group."""
    h = np.full(len(rows), xxhash.xxh64_intdigest(grp.encode()), np.uint64)
    for t in range(rows.shape[1]):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + token_hashes[rows[:, t]])
    return h >> np.uint64(64 - HASH_BITS)


def _token_hashes(window: _Window) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in window.names], np.uint64)


def _pack(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted hashes as five bytes each, counts as one byte or, after a 255, as eight."""
    small = np.minimum(counts, 255).astype(np.uint8)
    five = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    return len(hashes).to_bytes(4, "little") + five.tobytes() + small.tobytes() + counts[small == 255].astype("<i8").tobytes()


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(raw[:4], "little")
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :5] = np.frombuffer(raw, np.uint8, 5 * n, 4).reshape(n, 5)
    counts = np.frombuffer(raw, np.uint8, n, 4 + 5 * n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, "<i8", -1, 4 + 6 * n)
    return wide.view("<u8").ravel(), counts


def marked_hashes(dictionary: DataFrame, least: int, words: int) -> np.ndarray:
    """Bit set of the hashes whose phrases occur at least ``least`` times together; 2^28 bits whatever the size."""
    ranges = 1 << max((LONGEST * words // RANGE).bit_length(), 3)
    shift = HASH_BITS - ranges.bit_length() + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grp, window in _windows(batches):
            token_hashes = _token_hashes(window)
            found = [(_phrase_hashes(grp, rows, token_hashes), n) for rows, n in window.phrases()]
            if not found:
                continue
            h, n = (np.concatenate(c) for c in zip(*found))
            order = np.argsort(h)
            h, n = h[order], n[order]
            of = (h >> np.uint64(shift)).astype(np.int64)
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            blobs = [_pack(a, b) for a, b in zip(np.split(h, starts[1:]), np.split(n, starts[1:]))]
            yield pa.RecordBatch.from_arrays([pa.array(of[starts], pa.int64()), pa.array(blobs, pa.binary())], names=["part", "packed"])
        give_back()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hashes of one range at a time that reach the least count, as positions in the bit set."""

        def frequent(packed: list[bytes]) -> np.ndarray:
            h, n = (np.concatenate(c) for c in zip(*map(_unpack, packed)))
            order = np.argsort(h)
            h, n = h[order], n[order]
            starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            return np.unique(h[starts][np.add.reduceat(n, starts) >= least] & np.uint64((1 << MARK_BITS) - 1))

        def rows(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
            at = frequent(packed)
            if len(at):
                width = MARK_BITS - MARK_PARTS.bit_length() + 1
                of = (at >> np.uint64(width)).astype(np.int64)
                starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                inner = (at & np.uint64((1 << width) - 1)).astype("<u4")
                lists = [p.tobytes() for p in np.split(inner, starts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(of[starts], pa.int64()), pa.array(lists, pa.binary())], names=["part", "places"])

        now, packed = None, []
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != now and packed:
                    yield from rows(packed)
                    packed = []
                now = part
                packed.append(blob)
        if packed:
            yield from rows(packed)
        give_back()

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bit lists of the parts in a task; every list has the same fixed length."""
        width = (1 << MARK_BITS) // MARK_PARTS
        lists: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, places in zip(batch.column(0).to_pylist(), batch.column(1)):
                flags = lists.setdefault(part, np.zeros(width // 8, np.uint8))
                at = np.frombuffer(places.as_py(), "<u4")
                np.bitwise_or.at(flags, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        for part, flags in lists.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([flags.tobytes()], pa.binary())], names=["part", "flags"])
        give_back()

    packed = dictionary.select("grp", F.col("chunk").cast("binary").alias("chunk"), "freq").mapInArrow(count, "part bigint, packed binary")
    found = packed.repartition("part").sortWithinPartitions("part").mapInArrow(total, "part bigint, places binary")
    marks = np.zeros((1 << MARK_BITS) // 8, np.uint8)
    width = len(marks) // MARK_PARTS
    # at most MARK_PARTS lists of a fixed length: 32 MB
    for row in found.repartition("part").mapInArrow(bits, "part bigint, flags binary").collect():
        marks[row["part"] * width : (row["part"] + 1) * width] |= np.frombuffer(row["flags"], np.uint8)
    return marks


def phrase_counts(docs: DataFrame, least: int, text: str = "text", group: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(grp, phrase, size, f) of all phrases of 1 to 3 words that occur ``least`` times or more, and (grp, n) with all words."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/chunks-{uuid.uuid4().hex}"
    parse(docs, text, group).write.parquet(path)
    dictionary = spark.read.schema("grp string, chunk string, own bigint, freq bigint").parquet(path)
    totals = dictionary.groupBy("grp").agg(F.sum(F.col("own") * F.col("freq")).alias("n"))
    words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    marks = spark.sparkContext.broadcast(marked_hashes(dictionary, least, words))  # 32 MB at any size
    schema = "grp string, phrase string, size int, f bigint"
    fields = arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = marks.value
        for grp, window in _windows(batches):
            token_hashes, names = _token_hashes(window), window.token_list()
            for rows, n in window.phrases():
                at = _phrase_hashes(grp, rows, token_hashes) & np.uint64((1 << MARK_BITS) - 1)
                keep = flags[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1
                rows, n = rows[keep], n[keep]
                found = [b" ".join(map(names.__getitem__, row)) for row in rows.tolist()]
                columns = [
                    pa.array([grp] * len(found), pa.string()),
                    pa.array(found, pa.binary()).cast(pa.string()),
                    pa.array(np.full(len(found), rows.shape[1], np.int32)),
                    pa.array(n, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=fields)
        give_back()

    counted = (
        dictionary.select("grp", F.col("chunk").cast("binary").alias("chunk"), "freq")
        .mapInArrow(count, schema)
        .groupBy("grp", "phrase", "size")
        .agg(F.sum("f").alias("f"))
        .filter(F.col("f") >= least)
    )
    path = f"{shared_folder(spark)}/phrases-{uuid.uuid4().hex}"
    counted.write.parquet(path)
    return spark.read.schema(schema).parquet(path), totals


def collocations(
    docs: DataFrame, text: str = "text", group: str = "lang", least: int = 10, cover_percent: int = 50, top: int = 2000
) -> DataFrame:
    """The first ``top`` phrases of each group: grp, rank, phrase, a, l, r, n, score.

    A phrase of two or three words is scored by floor(10^6 a^2 / (l r)) of its worst cut. One whose words lie inside a
    longer phrase that occurs at least ``cover_percent`` percent as often is left out.
    """
    counts, totals = phrase_counts(docs, least, text, group)
    candidates = counts.filter("size >= 2").select("grp", "phrase", "size", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    cuts = (
        candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .withColumn("_w", words)
        .withColumns(
            {
                "first": F.array_join(F.slice("_w", F.lit(1), F.col("k")), " "),
                "rest": F.array_join(F.slice("_w", F.col("k") + 1, F.col("size") - F.col("k")), " "),
                # a frequent word is part of very many phrases, so its count is there SALTS times
                "salt1": F.when(F.col("k") == 1, F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(F.lit(0)),
                "salt2": F.when(F.col("size") - F.col("k") == 1, F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(F.lit(0)),
            }
        )
        .drop("_w")
    )
    salts = F.when(F.col("size") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))).cast("array<bigint>")
    parts = counts.filter(F.col("size") < LONGEST).select("grp", "phrase", "f", F.explode(salts).alias("salt"))
    first = parts.select("grp", F.col("phrase").alias("first"), F.col("salt").alias("salt1"), F.col("f").alias("l"))
    rest = parts.select("grp", F.col("phrase").alias("rest"), F.col("salt").alias("salt2"), F.col("f").alias("r"))
    big = {c: F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")}
    score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (big["a"] * big["a"]), big["l"] * big["r"])
    scored = (
        cuts.join(first, ["grp", "first", "salt1"])
        .join(rest, ["grp", "rest", "salt2"])
        .withColumn("score", score)
        .groupBy("grp", "phrase", "size", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    longer = candidates.filter(F.col("size") == LONGEST).withColumn("_w", words)
    inside = (
        longer.select("grp", F.col("a").alias("longer"), F.explode(F.expr("array(concat_ws(' ', _w[0], _w[1]), concat_ws(' ', _w[1], _w[2]))")).alias("phrase"))
        .groupBy("grp", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    kept = scored.join(inside, ["grp", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * cover_percent)
    )
    order = Window.partitionBy("grp").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    # a rank limit under the window leaves at most `top` rows of a group in each task before the shuffle
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "grp").select(
        "grp", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).withColumnRenamed("grp", "lang")


SQL = {
    "op11_collocations": r"""
WITH lines AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM lines),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i
        FROM (SELECT lang, ws, unnest([1, 2, 3]) AS k FROM w))),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT lang, size, phrase, a, c, array_to_string(ws[1:c], ' ') AS first, array_to_string(ws[c + 1:], ' ') AS rest
  FROM (SELECT *, unnest(generate_series(1, size - 1)) AS c FROM cand)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score,
         row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f), c) AS cut
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first JOIN f y ON y.lang = cuts.lang AND y.phrase = rest),
longer AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM cand WHERE size = 3)
  GROUP BY ALL),
kept AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase
  WHERE cut = 1 AND (longer IS NULL OR 100 * longer < 50 * a))
SELECT kept.lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN n ON n.lang = kept.lang WHERE rank <= 2000
"""
}
