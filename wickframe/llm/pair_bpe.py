"""BPE encoding and decoding by a pair occurrence index.

The vocabulary lower-cases NFC text, drops white space, splits the rest by a pattern, writes each piece as byte
letters with a mark at its end, and merges adjacent pairs by rank. Here all different pieces of a part of a partition
are merged together through an index of the pairs that have a rank. For pieces of up to ``WIDTHS[-1]`` bytes it is a matrix with
the rank of the pair at each position, one piece a column: each round applies the lowest rank of every piece, the leftmost of equal ones,
and the pairs that a merge makes enter the index. For longer pieces it maps each pair to all positions where it stands, the ranks
that are present are applied in ascending order, each at all its positions from left to right, and a merge enters the
pairs that it makes into the lists of their ranks. Entries that an earlier merge destroyed are recognised by their
symbols and passed over. This equals merging every piece on its own, since a pair that holds a merged symbol ranks
after the merge that makes it; a vocabulary where that is not so is refused.

Words recur, so only the different ones of a part are encoded (``words``), and a task keeps the ids of words of other than
small letters in a bounded memo.

Nulls, ties and edge cases: a null text is an empty one, without ids and with an empty decoded text. Equal pairs that
overlap (``aaa``) merge from the left. The two special tokens are found in the raw text, as the library does, and get their ids.
White space inside no piece leaves no trace, so decoding gives the tokens joined by spaces and not the text. Repeated rows
are encoded one by one; a null doc_id stays null; columns besides doc_id and text are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.byte_bpe import SPACE
from wickframe.llm.common import arrow_schema, give_back, table
from wickframe.llm.memo import Memo
from wickframe.llm.words import bytes_of, encode_texts, large_binary, parts, rows_of

#: Rows of ids that are decoded together.
ROWS = 512
#: Bytes of the longest pieces that are merged side by side, by width of the matrix, and bits of a place there.
WIDTHS = (6, 9, 12, 16, 24, 40)
PLACE = 6
#: Stands for "no rank"; higher than every rank with its place.
NONE = 1 << 30


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b <= 0xFF and b != 0xAD)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PairTable:
    """Ranks of pairs of symbols in tables by hash; a pair whose slot is taken goes on to the next table."""

    def __init__(self, pairs: np.ndarray, base: int):
        self.base = base
        self.levels: list[tuple[np.uint64, np.uint64, np.ndarray, np.ndarray]] = []  # factor, shift, keys, ranks
        keys = pairs[:, 0] * base + pairs[:, 1]
        left, rng = np.arange(len(keys)), np.random.default_rng(0)
        while len(left):
            bits = max(int(4 * len(left)).bit_length(), 8)
            factor, shift = np.uint64(rng.integers(1 << 62, 1 << 63) | 1), np.uint64(64 - bits)
            slots, first = np.unique((keys[left].astype(np.uint64) * factor) >> shift, return_index=True)
            held, ranks = np.full(1 << bits, -1), np.full(1 << bits, NONE, np.int32)
            held[slots], ranks[slots] = keys[left[first]], left[first] << PLACE
            self.levels.append((factor, shift, held, ranks))
            left = np.delete(left, first)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair above ``PLACE`` empty bits, or NONE."""
        keys = a.astype(np.int64) * self.base + b
        hashed, out = keys.view(np.uint64), np.full(len(keys), NONE, np.int32)
        for factor, shift, held, ranks in self.levels:
            at = ((hashed * factor) >> shift).view(np.int64)
            hit = np.flatnonzero(held[at] == keys)
            out[hit] = ranks[at[hit]]
        return out


def small_letters(offsets: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Which bytes belong to small letters of ASCII or Latin-1. Words of them are one piece each and stay as they are."""
    lead = np.zeros(len(flat), bool)
    lead[:-1] = (flat[:-1] == 0xC3) & (flat[1:] >= 0x9F) & (flat[1:] <= 0xBF) & (flat[1:] != 0xB7)
    lead[offsets[1:] - 1] = False  # broken text: the next byte is another word's
    out = lead | (flat - ord("a") < 26)
    out[1:] |= lead[:-1]
    return out


def in_order(groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups of rows (numbers, joined ids, ids a row) put in order: all ids joined, ids a row."""
    counts = np.zeros(n, np.int64)
    for rows, _, many in groups:
        counts[rows] = many
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.int64)
    for rows, ids, many in groups:
        out[np.repeat(starts[rows] - (np.cumsum(many) - many), many) + np.arange(len(ids))] = ids
    return out, counts


class PairIndexBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, memo: int = 200_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, letters = spec["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or letters["add_prefix_space"] or spec["decoder"]:
            raise ValueError("the vocabulary normalises or splits in another way")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("the vocabulary finds its added tokens in another way")
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.letters = byte_letters()
        self.inner = np.array([vocab[c] for c in self.letters])
        self.last = np.array([vocab[c + self.end] for c in self.letters])
        self.size = max(vocab.values()) + 1
        self.rank: dict[int, int] = {}  # pair -> rank
        self.merges: list[tuple[int, int, int]] = []  # rank -> both symbols and the merged one
        source: dict[int, int] = {}  # merged symbol -> rank
        for r, (a, b) in enumerate(model["merges"]):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if max(source.get(x, -1), source.get(y, -1)) >= r or z in source:
                raise ValueError("merges are not in the order in which their symbols arise")
            self.rank[x * self.size + y] = r
            self.merges.append((x, y, z))
            source[z] = r
        # ranks of the pairs that stand in unmerged pieces, by both bytes and whether the second is the last one
        self.first_ranks = np.full((256, 256, 2), -1, np.int32)
        for kind, second in enumerate((self.inner, self.last)):
            byte_of = {s: b for b, s in enumerate(second.tolist())}
            first_of = {s: b for b, s in enumerate(self.inner.tolist())}
            for r, (x, y, _) in enumerate(self.merges):
                if x in first_of and y in byte_of:
                    self.first_ranks[first_of[x], byte_of[y], kind] = r
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        self.find_added = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")")
        pattern = split["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}"))
        self.gaps = regex.compile(f"[{SPACE}]+")
        self.made = np.array([z for _, _, z in self.merges], np.int32)
        self.pairs = PairTable(np.array([m[:2] for m in self.merges], np.int64).reshape(-1, 2), self.size + 1)
        self.spaced = pa.array([(self.tokens.get(i, "") + " ").encode() for i in range(max(self.tokens) + 1)], pa.large_binary())
        self.memo = Memo(None, memo)

    def words(self, text: str) -> list[str]:
        """Strings between white space; the separators of U+001C to U+001F are none here."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [w for w in self.gaps.split(text) if w]
        return text.split()

    def _split(self, word: str) -> list[str | int]:
        """Pieces of a string, and ids of added tokens."""
        out: list[str | int] = []
        for part in self.find_added.split(word) if "<|" in word else [word]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                # a capital sigma gets its plain small form everywhere
                plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out += [plain] if plain.isalpha() else self.pieces.findall(plain)
        return out

    def _encode_new(self, words: list[bytes], plain: np.ndarray, sizes: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Ids of different words; and ids, and their numbers, of pieces that are joined in ``plain``, all merged together."""
        split = [self._split(w.decode("utf-8", "replace")) for w in words]
        pieces = list(dict.fromkeys(p for parts in split for p in parts if isinstance(p, str)))
        raws = [p.encode() for p in pieces]
        joined = np.frombuffer(b"".join(raws), np.uint8)
        ids, counts = self.merge(np.append(plain, joined), np.append(sizes, np.array(list(map(len, raws)), np.int64)))
        rest = int(counts[: len(sizes)].sum())
        found: dict[str | int, bytes] = {i: i.to_bytes(4, "little") for i in self.added.values()}
        found.update(zip(pieces, rows_of(large_binary(np.append(0, 4 * counts[len(sizes) :].cumsum()), ids[rest:].astype("<u4")))))
        return [b"".join(map(found.__getitem__, parts)) for parts in split], ids[:rest], counts[: len(sizes)]

    def merge(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces that are joined in ``flat``, and their numbers: short pieces by the matrices of their pairs, others by the lists of positions."""
        ends = np.cumsum(sizes)
        last = np.zeros(len(flat), bool)
        last[ends - 1] = True
        ranks = np.full(len(flat), -1, np.int32)  # of the pairs that begin at each byte
        ranks[:-1] = self.first_ranks[flat[:-1], flat[1:], last[1:].astype(np.int8)]
        ranks[last] = -1
        symbols = np.where(last, self.last[flat], self.inner[flat]).astype(np.int32)
        done = []
        for low, width in zip((0, *WIDTHS), WIDTHS):
            rows = np.flatnonzero((sizes > low) & (sizes <= width))
            done += self._merge_short(symbols, ranks, ends[rows] - sizes[rows], rows, sizes[rows], width)
        rows = np.flatnonzero(sizes > WIDTHS[-1])
        if len(rows):
            held = np.repeat(sizes > WIDTHS[-1], sizes)
            done.append((rows, *self._merge_long(symbols[held], ranks[held], last[held])))
        return in_order(done, len(sizes))

    def _merge_short(self, all_symbols, all_ranks, starts, rows, sizes, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Merge pieces of at most ``width`` bytes side by side, one piece a column; numbers of pieces, their ids, and how many each has."""
        places = np.arange(width + 1, dtype=np.int32)[:, None]
        held = places < sizes
        at = np.where(held, starts + places, 0)
        symbols = np.where(held, all_symbols[at], np.int32(self.size))  # behind a piece stands a symbol that pairs with none
        # the index: the rank of the pair that stands at each place, above PLACE empty bits
        index = all_ranks[at[:-1]]
        index = np.where(held[:-1] & (index >= 0), index << PLACE, np.int32(NONE))
        while len(rows):
            least = (index + places[: len(index)]).min(0)  # the lowest rank of each piece, the leftmost of equal ones
            live = least < NONE
            done = np.flatnonzero(~live)
            if len(done):
                ids = symbols.take(done, 1).T
                kept = ids != self.size
                yield rows[done], ids[kept], kept.sum(1)
                live = np.flatnonzero(live)
                rows, symbols, index, least = rows[live], symbols.take(live, 1), index.take(live, 1), least[live]
                if not len(rows):
                    break
            at, made = least & ((1 << PLACE) - 1), self.made[least >> PLACE]
            # the left place takes the merged symbol; the right place and its pair leave, and the pairs with the merged symbol enter
            symbols = np.where(places[: len(symbols) - 1] > at, symbols[1:], symbols[:-1])
            index = np.where(places[: len(index) - 1] >= at, index[1:], index[:-1])
            n = np.arange(len(rows))
            symbols[at, n] = made
            inner = np.flatnonzero(at)
            left = at[inner] - 1
            entered = self.pairs.get(np.concatenate([made, symbols[left, inner]]), np.concatenate([symbols[at + 1, n], made[inner]]))
            index[at, n], index[left, inner] = entered[: len(n)], entered[len(n) :]

    def _merge_long(self, first_symbols: np.ndarray, ranks: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of joined pieces of any length, and their numbers, all merged together through the lists of positions."""
        # the index: positions of every pair that has a rank, in order
        at = np.flatnonzero(ranks >= 0)
        ranks = ranks[at]
        order = np.argsort(ranks, kind="stable")
        present, starts = np.unique(ranks[order], return_index=True)
        places = dict(zip(present.tolist(), map(np.ndarray.tolist, np.split(at[order], starts[1:]))))
        active = list(places)
        heapq.heapify(active)
        symbols = first_symbols.tolist()
        after = np.where(last, -1, np.arange(1, len(last) + 1)).tolist()
        before = np.where(np.append(True, last[:-1]), -1, np.arange(-1, len(last) - 1)).tolist()
        size, rank, push = self.size, self.rank.get, heapq.heappush
        while active:
            now = heapq.heappop(active)
            a, b, made = self.merges[now]
            here = places.pop(now)
            for i in sorted(here) if a == b else here:
                j = after[i]
                if symbols[i] != a or j < 0 or symbols[j] != b:
                    continue  # an earlier merge took one of the two
                k, h = after[j], before[i]
                symbols[i], symbols[j], after[i] = made, -1, k
                if k >= 0:
                    before[k] = i
                    r = rank(made * size + symbols[k])
                    if r is not None:
                        if r in places:
                            places[r].append(i)
                        else:
                            places[r] = [i]
                            push(active, r)
                if h >= 0:
                    r = rank(symbols[h] * size + made)
                    if r is not None:
                        if r in places:
                            places[r].append(h)
                        else:
                            places[r] = [h]
                            push(active, r)
        merged = np.array(symbols, np.int64)
        kept = merged >= 0
        return merged[kept], np.diff(np.cumsum(kept)[last], prepend=0)

    def learn(self, words: pa.Array) -> pa.Array:
        """Ids of different words; those that are not of small letters only are remembered for a while."""
        offsets, flat = bytes_of(words)
        sizes = np.diff(offsets)
        odd = np.unique(np.searchsorted(offsets, np.flatnonzero(~small_letters(offsets, flat)), "right") - 1)
        small = np.ones(len(words), bool)
        small[odd] = False
        keys, memo = [flat[i:j].tobytes() for i, j in zip(offsets[odd].tolist(), offsets[odd + 1].tolist())], self.memo
        new = [w for w in keys if w not in memo and not memo.recall(w)]
        made, ids, counts = self._encode_new(new, flat[np.repeat(small, sizes)], sizes[small])
        known = dict(zip(new, made))
        found = [known[w] if w in known else memo[w] for w in keys]
        if len(memo) + len(known) > memo._size:
            memo.age()
        memo.update(known)
        rest = np.frombuffer(b"".join(found), "<u4")
        ids, counts = in_order([(np.flatnonzero(small), ids, counts), (odd, rest, np.array([len(f) // 4 for f in found], np.int64))], len(words))
        return large_binary(np.append(0, 4 * counts.cumsum()), ids.astype("<u4"))

    def _whole(self, text: bytes) -> bytes:
        words = list(map(str.encode, self.words(text.decode("utf-8", "replace"))))
        return b"".join(self._encode_new(words, np.zeros(0, np.uint8), np.zeros(0, np.int64))[0])

    def encode_array(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """Ids of each text as little-endian unsigned 32-bit integers, followed by ``end``."""
        return encode_texts(texts, self.learn, self._whole, end)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return rows_of(self.encode_array(pa.array([t.encode("utf-8", "replace") for t in texts], pa.large_binary())))

    def decode_array(self, ids: pa.Array) -> list[bytes]:
        """Text of each row of ids (little-endian unsigned 32-bit integers), in UTF-8."""
        offsets, flat = bytes_of(ids)
        stops, text = bytes_of(self.spaced.take(pa.array(flat.view("<u4"))))
        stops = stops[offsets // 4].tolist()
        text = text.tobytes()
        return [text[i : max(i, j - 1)] for i, j in zip(stops, stops[1:])]

    def decode(self, ids: bytes) -> str:
        return self.decode_array(pa.array([ids], pa.large_binary()))[0].decode()


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> PairIndexBpe:
    """One a process; a task that is done clears its memo."""
    return PairIndexBpe(path)


def _per_document(docs: DataFrame, path: str, schema: str, columns) -> DataFrame:
    """doc_id and ``columns(bpe, ids)`` of the ids of many documents (little-endian unsigned 32-bit integers)."""
    fields = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            for start, stop in parts(batch.column(1)):
                keys, texts = batch.slice(start, stop - start).columns
                found = columns(bpe, bpe.encode_array(texts))
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip([keys, *found], fields)], schema=fields)
        bpe.memo.forget()
        give_back()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and token ids of every text."""
    
    def columns(bpe: PairIndexBpe, ids: pa.Array):
        offsets, flat = bytes_of(ids)
        return [pa.ListArray.from_arrays(pa.array(offsets // 4, pa.int32()), pa.array(flat.view("<i4")))]

    return _per_document(docs, tokenizer_path, "doc_id bigint, ids array<int>", columns)


def decode_documents(tokens: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and the tokens of its ids, joined by spaces; null ids are none."""
    schema = "doc_id bigint, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [bpe.decode(np.array(ids or [], "<u4").tobytes()) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, schema)


def op13_pair_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    def columns(bpe: PairIndexBpe, ids: pa.Array):
        raws, texts = rows_of(ids), bpe.decode_array(ids)
        return [len(r) // 4 for r in raws], [hashlib.sha256(r).hexdigest() for r in raws], [hashlib.sha256(t).hexdigest() for t in texts]

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _per_document(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), schema, columns)
