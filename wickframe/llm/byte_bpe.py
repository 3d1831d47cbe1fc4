"""Byte-level BPE encoding and decoding with two tiers.

A text is split by the vocabulary's pattern. Each different piece is first looked up whole: a minimal
perfect hash over the vocabulary (levels of bit sets; keys that collide on a level go on to the next)
names the only entry it can be, and one comparison decides. A piece that is no entry is merged: the adjacent pair with
the lowest rank, the leftmost of equal ones, becomes one until no pair has a rank. The bytes of a piece longer than
``SHORT`` form a linked list, and a heap yields the pairs. Shorter pieces that are new in a part of a batch are merged side
by side: the ranks of all their pairs lie in one matrix, and each round merges the lowest pair of every piece.
Results are remembered within a task.

Nulls, ties and edge cases: a null text is an empty one and has no ids; decoding gives back the exact bytes;
every single byte must have a rank, else building the encoder fails. Columns besides id and text are
ignored, and repeated rows are encoded one by one.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.common import arrow_schema, give_back, map_rows, table, text_groups
from wickframe.llm.memo import Memo

#: White space as the pattern's \s means it (the Unicode property).
SPACE = r"\t-\r \x85\xa0  -     　"

#: Bytes of the longest pieces that are merged side by side, by width of the matrix.
WIDTHS = (8, 16, 32)
SHORT = WIDTHS[-1]
#: Stands for "no rank".
NONE = np.iinfo(np.int32).max


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PerfectHash:
    """Minimal perfect hash over byte strings: ``index(keys)`` is 0..n-1 for members, anything or -1 for others."""

    def __init__(self, keys: list[bytes], slack: float = 2.0):
        left = self._hashes(keys)
        if len(np.unique(left)) != len(left):
            raise ValueError("two keys have the same hash")
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # bits, and ones before them
        before = 0
        while len(left):
            at = self._slots(left, len(self.levels), max(int(slack * len(left)), 1))
            counts = np.bincount(at, minlength=max(int(slack * len(left)), 1))
            bits = counts == 1
            ranks = before + np.cumsum(bits) - bits
            self.levels.append((bits, ranks))
            before += int(bits.sum())
            left = left[~bits[at]]

    @staticmethod
    def _hashes(keys: list[bytes]) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)

    @staticmethod
    def _slots(h: np.ndarray, level: int, size: int) -> np.ndarray:
        x = (h + np.uint64(level)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def index(self, keys: list[bytes]) -> np.ndarray:
        h = self._hashes(keys)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(self.levels):
            at = self._slots(h[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        return out


class ByteBpe:
    """Encoder and decoder for ranks (bytes -> id) and a splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = 200_000):
        self.ranks = ranks
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        keys = list(ranks)
        self.hash = PerfectHash(keys)
        place = self.hash.index(keys)
        self.entries: list[bytes] = [b""] * len(keys)
        for k, i in zip(keys, place.tolist()):
            self.entries[i] = k
        self.ids = [ranks[k].to_bytes(4, "little") for k in self.entries]
        self.bytes_of = {i: k for k, i in ranks.items()}
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"bytes without a rank: {missing[:5]}")
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.base = max(ranks.values()) + 2  # the last symbol below it is the filling of short rows
        self.pairs, self.pair_ranks = self._pairs()
        self.memo = Memo(self._piece, memo)

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of symbols that make an entry, in order, and its rank; one more that no pair can be."""
        get, both, made = self.ranks.get, [self.base**2], [NONE]
        for k, r in self.ranks.items():
            for i in range(1, len(k)):
                a = get(k[:i])
                if a is not None:
                    b = get(k[i:])
                    if b is not None:
                        both.append(a * self.base + b)
                        made.append(r)
        both = np.array(both, np.int64)
        order = both.argsort()
        return both[order], np.array(made, np.int32)[order]

    def _piece(self, piece: str) -> bytes:
        return self._new([piece])[0]

    def _new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces (both tiers), as little-endian unsigned 32-bit integers."""
        raws = [p.encode("utf-8", "replace") for p in pieces]
        found = [self.ids[at] if at >= 0 and self.entries[at] == raw else None for raw, at in zip(raws, self.hash.index(raws).tolist())]
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(rest, self.merge_all([raws[i] for i in rest])):
            found[i] = ids
        return found

    def learn(self, pieces: set[str]) -> None:
        """Look up many pieces at once and remember the result."""
        memo = self.memo
        new = [p for p in pieces.difference(memo) if not memo.recall(p)]
        known = dict(zip(new, self._new(new)))
        if len(memo) + len(known) > memo._size:
            memo.age()
        memo.update(known)

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.base + b
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], NONE)

    def merge_all(self, raws: list[bytes]) -> list[bytes]:
        """``merge`` of many pieces, the short ones side by side."""
        out: list[bytes] = [b""] * len(raws)
        sizes = np.array([len(r) for r in raws], np.int64)
        for low, width in zip((0, *WIDTHS), WIDTHS):
            rows = np.flatnonzero((sizes > low) & (sizes <= width))
            if not len(rows):
                continue
            # symbols of each piece, then the filling, in one column at least
            symbols = np.full((len(rows), width + 1), self.base - 1, np.int32)
            flat = np.frombuffer(b"".join([raws[i] for i in rows.tolist()]), np.uint8)
            symbols[np.arange(width + 1) < sizes[rows, None]] = self.single[flat]
            ranks = self._pair_ranks(symbols[:, :-1], symbols[:, 1:])
            while len(rows):
                at = ranks.argmin(1)
                made = ranks[np.arange(len(rows)), at]
                live = made != NONE
                if not live.all():
                    done = symbols[~live]
                    kept = done != self.base - 1
                    ids = done[kept].astype("<u4").tobytes()
                    stops = (4 * kept.sum(1).cumsum()).tolist()
                    for i, start, stop in zip(rows[~live].tolist(), [0, *stops], stops):
                        out[i] = ids[start:stop]
                    rows, symbols, ranks, at, made = rows[live], symbols[live], ranks[live], at[live], made[live]
                    if not len(rows):
                        break
                # the pair becomes its left place, and the right place and its pair leave
                n = np.arange(len(rows))
                symbols[n, at] = made
                kept = np.ones(symbols.shape, bool)
                kept[n, at + 1] = False
                symbols, ranks = symbols[kept].reshape(len(n), -1), ranks[kept[:, :-1]].reshape(len(n), -1)
                ranks[n, at] = self._pair_ranks(made, symbols[n, at + 1])
                n = np.flatnonzero(at)
                left = at[n] - 1
                ranks[n, left] = self._pair_ranks(symbols[n, left], made[n])
        for i in np.flatnonzero(sizes > SHORT).tolist():
            out[i] = self.merge(raws[i])
        return out

    def merge(self, raw: bytes) -> bytes:
        n, rank = len(raw), self.ranks.get
        after = list(range(1, n + 1))  # end of the part that starts here
        before = list(range(-1, n - 1))  # start of the part before
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = after[i]
            if middle < 0 or middle >= n or after[middle] != end:
                continue  # one of the two parts has changed
            after[i], after[middle] = end, -1
            if end < n:
                before[end] = i
                stop = after[end]
                if (r := rank(raw[i:stop])) is not None:
                    heapq.heappush(heap, (r, i, stop))
            if before[i] >= 0 and (r := rank(raw[before[i] : end])) is not None:
                heapq.heappush(heap, (r, before[i], end))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[raw[i : after[i]]].to_bytes(4, "little"))
            i = after[i]
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        split = list(map(self.pattern.findall, texts))
        self.learn(set().union(*split))
        # pieces of one part may push each other out of the memo, which then computes them again
        return [b"".join(map(self.memo.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _per_document(docs: DataFrame, ranks_path: str, pattern: str, schema: str, row: Callable) -> DataFrame:
    """``row(bpe, doc_id, ids)`` for every document; the pieces of a part of a batch are looked up together."""
    fields = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(load_ranks(ranks_path), pattern)
        for batch in batches:
            for keys, texts in text_groups(batch):
                rows = [row(bpe, i, found) for i, found in zip(keys, bpe.encode_all(texts))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)
        del bpe
        give_back()

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and token ids of every text."""
    return _per_document(docs, ranks_path, pattern, "doc_id bigint, ids array<int>", lambda bpe, i, ids: (i, np.frombuffer(ids, "<i4")))


def decode_documents(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and text bytes of token ids."""

    def make():
        bpe = ByteBpe(load_ranks(ranks_path), pattern)
        return lambda row: [(row[0], bpe.decode(np.array(row[1] or [], "<u4").tobytes()))]

    return map_rows(tokens.select("doc_id", "ids"), "doc_id bigint, text binary", make)


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    def both_ways(bpe: ByteBpe, i, ids: bytes):
        return i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _per_document(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, schema, both_ways)
