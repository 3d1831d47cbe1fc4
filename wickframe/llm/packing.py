"""Packing by lexical retrieval.

Documents are tokenised once, and the documents and tokens of the whole corpus are counted, so BM25 weights
are those of the whole corpus. Then documents are routed to shards of about ``SHARD_TOKENS`` tokens by lexical
likeness, wherever they lie: a tree of two-means splits is grown on a sample of projected BM25 vectors,
every document descends it, and leaves side by side fill a shard. A leaf too large for one shard whose
documents the tree cannot tell apart (copies) is dealt over several. A task builds a BM25 inverted index over
each shard and packs it: the first unused document is the seed of a window, and the unused documents that
score best for the seed's terms, common ones included, follow until the window is full. Postings of used documents leave the index now and then. A document that does not fit is cut,
and its rest is the seed of the next window. What is left at the end of a shard goes into sequences whose lengths are
powers of two, so nothing is padded. Neighbours in another shard are not found; the README has the measured
share. Tokens are written to the shared folder and shuffled once, and jobs run when the function is called.

The tokenizer splits at white space, and between a letter and the punctuation behind it, before it
merges anything. So the texts of a part of a batch are split there together, each different word gets its ids once
(``pair_bpe``, whose ids are those of the tokenizers library), and they are put back at all its places.
In a shard of ``MATRIX`` documents the terms that many documents hold are scored by one product of matrices, the others
from their postings; weights are multiples of 2**-36, so a sum is the same in any order.

Nulls, ties and edge cases: a null text is an empty one and has only the end token; equal scores go
to the document that comes first; repeated rows are packed each; a very long document fills whole
windows of its own; columns besides the id and the text are ignored.
"""

from __future__ import annotations

import functools
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.common import arrow_schema, give_back, shared_folder, table
from wickframe.llm.pair_bpe import encoder
from wickframe.llm.words import bytes_of, large_binary, parts, rows_of

WINDOW = 2048
END = 1
SHARD_TOKENS = 2_000_000
LEAF = 0.25  # tokens of a leaf of the routing tree, in shards
SAMPLE = 100  # documents a shard that the tree is grown on, at least 5,000 in all and at most 200,000
DIMS = 128  # of the projected vectors
K1, B = 1.2, 0.75
EXACT = 2.0**-36  # weights are multiples of it
MATRIX, FREQUENT, COLUMNS = (64, 3000), 12, 512  # documents of a shard whose frequent terms (in one of twelve) are scored at once, so many terms a product
ROWS = 512  # documents whose stored ids are counted together


class PieceEncoder:
    """Exact ids of texts (UTF-8 bytes in, little-endian unsigned 32-bit ids out)."""

    def __init__(self, path: str):
        self.bpe = encoder(path)
        self.size = max(self.bpe.tokens) + 1  # ids are below it

    def encode(self, texts: list[bytes]) -> list[bytes]:
        return rows_of(self.bpe.encode_array(pa.array(texts, pa.large_binary())))

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids begin, and all ids, each text's with the end token."""
        offsets, ids = bytes_of(self.bpe.encode_array(texts, np.array([END], "<u4").tobytes()))
        return offsets // 4, ids.view("<u4")


@dataclass
class Statistics:
    """Documents, tokens and documents by term of the whole corpus."""

    n: int
    tokens: int
    df: np.ndarray

    def weights(self, term: np.ndarray, tf: np.ndarray, size) -> np.ndarray:
        """BM25 weights of postings."""
        df = self.df[term]
        idf = np.log(1 + (self.n - df + 0.5) / (df + 0.5))
        return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / (self.tokens / self.n)))


class Shard:
    """BM25 inverted index over the documents of one shard (arrays of ids), by default with its own statistics."""

    def __init__(self, docs: list[np.ndarray], statistics: Statistics | None = None):
        self.n = len(docs)
        sizes = np.array([len(d) for d in docs], np.int64)
        starts = np.append(0, sizes.cumsum())
        ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
        if len(ids) and ids.max() < 1 << 16:
            ids = ids.astype(np.uint16)
        doc, term, tf = count_terms(starts, ids)
        # postings by term, and the terms of each document, as places in ``term``
        order = np.argsort(term.astype(ids.dtype), kind="stable")
        self.term, df = np.unique(term, return_counts=True)
        numbers = np.searchsorted(self.term, term)
        self.terms = np.split(numbers.astype(np.int32), np.searchsorted(doc, np.arange(1, self.n)))
        first = np.cumsum(df) - df
        self.first, self.df = first, df
        self.doc, tf = doc[order], tf[order]
        numbers = numbers[order]
        self.last = first + df
        if statistics is None:
            own = np.zeros(int(self.term[-1]) + 1 if len(self.term) else 0, np.int64)
            own[self.term] = df
            statistics = Statistics(max(self.n, 1), max(int(sizes.sum()), 1), own)
        # multiples of a power of two, whose sums are exact in any order
        self.weight = np.rint(statistics.weights(np.repeat(self.term, df), tf, sizes[self.doc]) / EXACT) * EXACT
        self.docs = docs
        self.rare = df > 1
        self.common = np.zeros((self.n, 0))
        if MATRIX[0] <= self.n <= MATRIX[1]:
            self._multiply(numbers)

    def _multiply(self, numbers: np.ndarray) -> None:
        """``common``: the scores of all documents for the frequent terms of all documents, as one product of matrices."""
        often = np.flatnonzero(self.df * FREQUENT > self.n)
        self.rare[often] = False
        self.common = np.zeros((self.n, self.n))
        column = np.full(len(self.df), -1)
        for at in range(0, len(often), COLUMNS):
            some = often[at : at + COLUMNS]
            column[some] = np.arange(len(some))
            here = np.flatnonzero(column[numbers] >= 0)
            doc, place = self.doc[here], column[numbers[here]]
            held, weights = np.zeros((self.n, len(some))), np.zeros((len(some), self.n))
            held[doc, place] = 1
            weights[place, doc] = self.weight[here]
            self.common += held @ weights
            column[some] = -1

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of all documents for the terms of ``seed``; terms of no other document add nothing to the others."""
        at = self.terms[seed]
        at = at[self.rare[at]]
        known = self.common[seed] if self.common.size else np.zeros(self.n)
        if not len(at):
            return known.copy()
        parts = list(map(slice, self.first[at].tolist(), self.last[at].tolist()))
        return np.bincount(np.concatenate([self.doc[p] for p in parts]), np.concatenate([self.weight[p] for p in parts]), self.n) + known

    def drop(self, used: np.ndarray) -> None:
        """Leave out the postings of used documents, which no search asks for again."""
        kept = ~used[self.doc]
        ends = np.append(0, kept.cumsum())
        self.first, self.last = ends[self.first], ends[self.last]
        self.doc, self.weight = self.doc[kept], self.weight[kept]

    def order(self, window: int = WINDOW):
        """Documents in packing order: best unused neighbours of each window's seed."""
        used = np.zeros(self.n, bool)
        next_seed, filled, free, indexed = 0, 0, self.n, self.n
        seed = None
        while True:
            if seed is None:
                while next_seed < self.n and used[next_seed]:
                    next_seed += 1
                if next_seed == self.n:
                    return
                seed = next_seed
                used[seed] = True
                free -= 1
                yield seed
                filled += len(self.docs[seed])
                if filled >= window:
                    filled %= window
                    seed = seed if filled else None  # its rest opens a window
                    continue
            if free < 0.8 * indexed:
                self.drop(used)
                indexed = free
            found = self.scores(seed)
            found[used] = -1
            fresh = seed
            for i in best(found, window):
                used[i] = True
                free -= 1
                yield i
                filled += len(self.docs[i])
                if filled >= window:
                    filled %= window
                    fresh = i if filled else None
                    break
            else:
                fresh = None  # no neighbour is left: the next unused document goes on in this window
            seed = fresh


def best(found: np.ndarray, most: int):
    """Places of the highest scores above 0, the first of equal ones first."""
    for _ in range(min(most, 8)):  # a window rarely takes more
        i = int(found.argmax())
        if found[i] <= 0:
            return
        found[i] = -1
        yield i
    near = np.argsort(-found, kind="stable")[: max(most - 8, 0)]
    yield from near[found[near] > 0].tolist()


def pack(docs: list[tuple[int, bytes]], statistics: Statistics | None = None):
    """Documents (id, ids as bytes, with the end token) -> pieces (id, start, ids, size, sequence, offset)."""
    shard = Shard([np.frombuffer(d, "<u4") for _, d in docs], statistics)
    total = sum(len(d) for _, d in docs) // 4
    # whole windows, then powers of two from the smallest up, so that a longer document at the end finds the larger room
    left, sequence, offset, room = total, 0, 0, 0

    def next_room() -> int:
        return WINDOW if left >= WINDOW else left & -left

    room = next_room() if total else 0
    for i in shard.order():
        key, raw = docs[i]
        size, start = len(raw) // 4, 0
        while start < size:
            take = min(size - start, room - offset)
            yield key, start, raw[4 * start : 4 * (start + take)], size, sequence, offset
            start, offset, left = start + take, offset + take, left
            if offset == room:
                left -= room
                sequence, offset = sequence + 1, 0
                room = next_room() if left else 0


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def tokens_of(ids: bytes, size: int) -> np.ndarray:
    """Stored ids, of two or four bytes."""
    return np.frombuffer(ids, f"<u{len(ids) // size}").astype("<u4")


def ids_of(sizes: pa.Array, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the stored ids of each row begin, and all ids."""
    starts = np.append(0, np.cumsum(sizes.to_numpy()))
    _, flat = bytes_of(ids)
    return starts, flat.view(f"<u{len(flat) // max(int(starts[-1]), 1) or 4}")


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, tokens with the end token, and their ids; written to the shared folder and read again."""
    schema = "doc_id bigint, size bigint, ids binary"
    fields = arrow_schema(schema)

    def run(batches):
        pieces = PieceEncoder(tokenizer_path)
        kind = "<u2" if pieces.size <= 1 << 16 else "<u4"
        width = np.dtype(kind).itemsize
        for batch in batches:
            for at, stop in parts(batch.column(1)):
                keys, texts = batch.slice(at, stop - at).columns
                starts, ids = pieces.encode_array(texts)
                columns = [keys, pa.array(np.diff(starts)), large_binary(starts * width, ids.astype(kind))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, fields)], schema=fields)
        pieces.bpe.memo.forget()
        give_back()

    path = f"{shared_folder(docs.sparkSession)}/packing-{uuid.uuid4().hex}"
    found = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(run, schema)
    found.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def count_terms(starts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different terms of each row, ascending: row, term and how often it is there."""
    bits, kind = (16, np.uint32) if ids.itemsize == 2 and len(starts) <= 1 << 16 else (32, np.uint64)
    row = np.repeat(np.arange(len(starts) - 1, dtype=kind), np.diff(starts))
    keys = np.sort((row << kind(bits)) | ids)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    keys = keys[first]
    return (keys >> kind(bits)).astype(np.int64), (keys & kind((1 << bits) - 1)).astype(np.int64), np.diff(first, append=len(row))


def corpus_statistics(encoded: DataFrame) -> Statistics:
    """Counted by task and summed; term -1 stands for documents, -2 for tokens."""
    schema = "term bigint, n bigint"
    fields = arrow_schema(schema)

    def run(batches):
        df, n, tokens = np.zeros(0, np.int64), 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                starts, ids = ids_of(*batch.slice(at, ROWS).columns)
                found = np.bincount(count_terms(starts, ids)[1], minlength=len(df))
                found[: len(df)] += df
                df, n, tokens = found, n + len(starts) - 1, tokens + int(starts[-1])
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(df[at], [n, tokens]))], schema=fields)

    counts = encoded.select("size", "ids").mapInArrow(run, schema).groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in counts.collect()}
    df = np.zeros(max(found, default=-1) + 1, np.int64)
    for term, n in found.items():
        if term >= 0:
            df[term] = n
    return Statistics(found.get(-1, 0), found.get(-2, 0), df)


@functools.lru_cache(maxsize=1)
def random_signs(terms: int) -> np.ndarray:
    """Made once a process."""
    return np.random.default_rng(0).choice(np.array([-1, 1], np.float32), (terms, DIMS))


class Projector:
    """Unit vectors of documents: BM25 weights under random signs by term."""

    def __init__(self, statistics: Statistics):
        self.statistics = statistics
        self.signs = random_signs(len(statistics.df))

    def vectors(self, starts: np.ndarray, ids: np.ndarray) -> np.ndarray:
        sizes = np.diff(starts)
        row, term, tf = count_terms(starts, ids)
        weights = self.statistics.weights(term, tf, sizes[row]).astype(np.float32)
        out = np.zeros((len(sizes), DIMS), np.float32)
        stops = np.searchsorted(row, np.arange(len(starts)))
        for i, (start, stop) in enumerate(zip(stops.tolist(), stops[1:].tolist())):
            out[i] = weights[start:stop] @ self.signs[term[start:stop]]
        return unit(out)


def unit(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)


class Router:
    """Tree of two-means splits over a sample; ``shards`` has the first shard and the number of shards of each leaf."""

    def __init__(self, x: np.ndarray, tokens: np.ndarray, shard_tokens: float):
        rng = np.random.default_rng(0)
        planes, self.children, self.shards = [], [], []
        full, stack = 0.0, [(np.arange(len(x)), None)]
        shard = 0
        while stack:
            at, place = stack.pop()
            weight = float(tokens[at].sum())
            side = self._split(x[at], rng) if weight > LEAF * shard_tokens and len(at) > 1 else None
            if side is None:
                here = ~len(self.shards)  # leaves count downwards from -1
                parts = max(1, round(weight / shard_tokens))
                if full and (parts > 1 or full + weight > shard_tokens):
                    shard, full = shard + 1, 0.0
                self.shards.append((shard, parts))
                shard, full = (shard + parts, 0.0) if parts > 1 else (shard, full + weight)
            else:
                here = len(planes)
                plane, right = side
                planes.append(plane)
                self.children.append([0, 0])
                stack += [(at[right], (here, 1)), (at[~right], (here, 0))]
            if place is not None:
                self.children[place[0]][place[1]] = here
        self.root = 0 if planes else -1
        self.planes = np.array(planes, np.float32).reshape(-1, DIMS)
        self.children, self.shards = np.array(self.children, np.int64).reshape(-1, 2), np.array(self.shards, np.int64)

    @staticmethod
    def _split(x: np.ndarray, rng):
        first = x[rng.integers(len(x))]
        centres = np.array([first, x[(x @ first).argmin()]])
        for _ in range(8):
            plane = centres[1] - centres[0]
            right = x @ plane > 0
            if right.all() or not right.any():
                return None
            centres = unit(np.array([x[~right].sum(0), x[right].sum(0)]))
        return plane, right

    def route(self, x: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """Shard of each vector; ``salt`` deals documents over the shards of one leaf."""
        node = np.full(len(x), self.root)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            right = np.einsum("ij,ij->i", x[inner], self.planes[at]) > 0
            node[inner] = self.children[at, right.astype(int)]
        first, parts = self.shards[~node].T
        return first + salt % parts


def route_documents(encoded: DataFrame, statistics: Statistics, shard_tokens: int = SHARD_TOKENS, rows: int = ROWS) -> DataFrame:
    """``encoded`` with the shard of each document."""
    if statistics.tokens <= shard_tokens:
        return encoded.withColumn("shard", F.lit(0).cast("bigint"))
    context = encoded.sparkSession.sparkContext
    share = min(1.0, min(max(5000, SAMPLE * statistics.tokens // shard_tokens), 200_000) / statistics.n)
    known = context.broadcast(statistics)

    def project(batches):
        projector = Projector(known.value)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                x = projector.vectors(*ids_of(*part.columns))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([v.tobytes() for v in x], pa.binary())], schema=sample_fields)

    sample_fields = arrow_schema("size bigint, x binary")
    picked = encoded if share == 1.0 else encoded.sample(share, seed=7)
    sample = picked.select("size", "ids").mapInArrow(project, "size bigint, x binary").collect()
    x = np.frombuffer(b"".join(bytes(r.x) for r in sample), np.float32).reshape(-1, DIMS)
    sizes = np.array([r["size"] for r in sample], np.float64)
    tree = context.broadcast(Router(x, sizes * (statistics.tokens / max(sizes.sum(), 1)), shard_tokens))
    schema = "doc_id bigint, size bigint, ids binary, shard bigint"
    fields = arrow_schema(schema)

    def run(batches):
        projector = Projector(known.value)
        salt = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                shard = tree.value.route(projector.vectors(*ids_of(part.column(1), part.column(2))), salt + np.arange(part.num_rows))
                salt += part.num_rows
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shard)], schema=fields)
        del projector
        give_back()

    return encoded.select("doc_id", "size", "ids").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, with_ids: bool = False, shard_tokens: int = SHARD_TOKENS, rows: int = ROWS) -> DataFrame:
    """Pieces of all documents; ``with_ids`` adds the token ids of each piece."""
    schema = PIECES + (", ids array<int>" if with_ids else "")
    fields = arrow_schema(schema)
    encoded = encode_documents(docs, tokenizer_path)
    statistics = corpus_statistics(encoded)
    routed = route_documents(encoded, statistics, shard_tokens, rows)
    known = docs.sparkSession.sparkContext.broadcast(statistics)

    def run(batches):
        base = TaskContext.get().partitionId() << 32
        shard: list[tuple[int, bytes]] = []
        current, tokens = None, 0

        def flush():
            nonlocal base
            out, last = [], -1
            for key, start, ids, size, sequence, offset in pack(shard, known.value):
                row = (key, start, len(ids) // 4, zlib.crc32(ids), size, base + sequence, offset)
                out.append((*row, np.frombuffer(ids, "<i4")) if with_ids else row)
                last = sequence
            base += last + 1
            for at in range(0, len(out), 10_000):
                columns = zip(*out[at : at + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, fields)], schema=fields)

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                for key, size, ids, number in zip(*(c.to_pylist() for c in batch.slice(at, rows).columns)):
                    # the sizes of shards are estimated from the sample; memory stays bounded where one is far larger
                    if shard and (number != current or tokens >= 2 * shard_tokens):
                        yield from flush()
                        shard, tokens = [], 0
                    current = number
                    shard.append((key, tokens_of(ids, size).tobytes()))
                    tokens += size
        if shard:
            yield from flush()
        del shard
        give_back()

    return routed.select("doc_id", "size", "ids", "shard").repartition("shard").sortWithinPartitions("shard", "doc_id").mapInArrow(run, schema)


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), word_tokenizer())
