"""Language of a text by a small convolutional network over bytes.

A text is lower-cased (A-Z) and cut into windows of ``WINDOW`` bytes, the last one filled up with
zeros. Each byte becomes a short vector; filters of two, three and four bytes run over the
window (in the tasks as sums of two looked-up answers to byte pairs), the largest answer of each filter is kept, and a softmax gives a probability per
language. A document gets the language with the largest mean log-probability over all its windows, so
every byte counts. The network is trained with numpy on the driver, on a bounded sample of
labelled rows, and runs in batches inside the tasks.

Nulls, ties and edge cases: a null text, or one without a letter, is ``und`` with score 0, as is every text when
there is nothing to learn from; rows with a null language or text teach nothing; equal
probabilities go to the language that sorts first; repeated rows are predicted one by one, and
columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickframe.llm.common import arrow_schema, table
from wickframe.llm.toxicity import remainder

WINDOW = 256  # bytes
DIM = 8  # numbers per byte
FILTERS = 12  # per width
WIDTHS = (2, 3, 4)
SPAN = max(WIDTHS)
BATCH = 16  # windows that are looked up at once
UNKNOWN = "und"
ASCII_LETTER = re.compile(rb"[A-Za-z]")


@dataclass
class ByteNet:
    """Weights: bytes x DIM, (SPAN * DIM) x filters (shorter filters hold zeros), bias, filters x languages, bias."""

    languages: list[str]
    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    out: np.ndarray
    _pairs: tuple | None = None

    @classmethod
    def new(cls, languages: list[str], seed: int = 7) -> "ByteNet":
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        embed = rng.normal(0, 0.5, (256, DIM)).astype(np.float32)
        embed[0] = 0  # the fill-up
        kernel = rng.normal(0, 0.3, (SPAN * DIM, n)).astype(np.float32) * cls.mask()
        dense = rng.normal(0, 0.3, (n, len(languages))).astype(np.float32)
        return cls(languages, embed, kernel, np.zeros(n, np.float32), dense, np.zeros(len(languages), np.float32))

    @staticmethod
    def mask() -> np.ndarray:
        m = np.zeros((SPAN * DIM, FILTERS * len(WIDTHS)), np.float32)
        for i, w in enumerate(WIDTHS):
            m[: w * DIM, i * FILTERS : (i + 1) * FILTERS] = 1
        return m

    def _positions(self, x: np.ndarray) -> np.ndarray:
        """(windows, positions, SPAN * DIM) view of the embedded bytes."""
        e = self.embed[x].reshape(len(x), -1)
        n = x.shape[1] - SPAN + 1
        return np.lib.stride_tricks.as_strided(e, (len(x), n, SPAN * DIM), (e.strides[0], 4 * DIM, 4), writeable=False)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self._positions(x)
        answers = (p.reshape(-1, SPAN * DIM) @ self.kernel).reshape(len(x), p.shape[1], -1)
        at = answers.argmax(1)
        return np.take_along_axis(answers, at[:, None], 1)[:, 0] + self.bias, at

    def _pair_answers(self) -> tuple[np.ndarray, np.ndarray]:
        """What each pair of bytes adds to the filters, as first and as second half of a span."""
        if self._pairs is None:
            pairs = np.concatenate([np.repeat(self.embed, 256, axis=0), np.tile(self.embed, (256, 1))], axis=1)
            self._pairs = pairs @ self.kernel[: 2 * DIM], pairs @ self.kernel[2 * DIM :]
        return self._pairs

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Per window; ``x`` holds bytes, windows x WINDOW."""
        done = []
        first, second = self._pair_answers()
        pairs = x[:, :-1].astype(np.int64) << 8 | x[:, 1:]
        n = WINDOW - SPAN + 1
        for i in range(0, len(x), BATCH):
            part = pairs[i : i + BATCH]
            answers = first.take(part[:, :n], axis=0)
            answers += second.take(part[:, 2 : n + 2], axis=0)
            z = np.maximum(answers.max(1) + self.bias, 0) @ self.dense + self.out
            done.append(z - np.logaddexp.reduce(z, axis=1, keepdims=True))
        return np.concatenate(done)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, rate: float = 0.01, batch: int = 64, seed: int = 11) -> "ByteNet":
        """Adam on the cross-entropy; only the position of each filter's largest answer gets a gradient."""
        rng = np.random.default_rng(seed)
        self._pairs = None
        names = ("embed", "kernel", "bias", "dense", "out")
        first = {k: np.zeros_like(getattr(self, k)) for k in names}
        second = {k: np.zeros_like(getattr(self, k)) for k in names}
        step, mask = 0, self.mask()
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                xb, yb = x[order[i : i + batch]], y[order[i : i + batch]]
                top, at = self.pooled(xb)
                hidden = np.maximum(top, 0)
                z = hidden @ self.dense + self.out
                p = np.exp(z - np.logaddexp.reduce(z, axis=1, keepdims=True))
                p[np.arange(len(yb)), yb] -= 1
                p /= len(yb)
                back = (p @ self.dense.T) * (top > 0)
                rows = np.arange(len(xb))[:, None]
                spans = self._positions(xb)[rows, at]  # windows x filters x (SPAN * DIM)
                grad = {
                    "dense": hidden.T @ p + 1e-4 * self.dense,
                    "out": p.sum(0),
                    "bias": back.sum(0),
                    "kernel": np.einsum("bf,bfk->kf", back, spans) * mask,
                    "embed": np.zeros_like(self.embed),
                }
                into = (back[:, :, None] * self.kernel.T[None]).reshape(len(xb), -1, SPAN, DIM)
                np.add.at(grad["embed"], xb[rows[:, :, None], at[:, :, None] + np.arange(SPAN)], into)
                grad["embed"][0] = 0
                step += 1
                pace = rate * (0.5 ** max(0, epoch - epochs // 2)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k in names:
                    first[k] = 0.9 * first[k] + 0.1 * grad[k]
                    second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                    setattr(self, k, (getattr(self, k) - pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32))
        return self

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and its probability for each (non-empty) text."""
        counts = np.array([-(-len(t) // WINDOW) for t in texts])
        x = np.frombuffer(b"".join(t.lower().ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts)), np.uint8)
        logs = self.log_probabilities(x.reshape(-1, WINDOW))
        weight = np.full(len(logs), WINDOW, float)
        last = counts.cumsum() - 1
        weight[last] = [len(t) - (n - 1) * WINDOW for t, n in zip(texts, counts)]
        starts = last - counts + 1
        mean = np.add.reduceat(logs * weight[:, None], starts, axis=0) / np.add.reduceat(weight, starts)[:, None]
        p = np.exp(mean - np.logaddexp.reduce(mean, axis=1, keepdims=True))
        best = p.argmax(1)
        return best, p[np.arange(len(p)), best]


def training_windows(texts: list[bytes], labels: list[int], per_text: int = 4, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of random place and length, from a few words to a whole window."""
    rng = np.random.default_rng(seed)
    x, y = [], []
    for text, label in zip(texts, labels):
        text = text.lower()
        for _ in range(per_text):
            size = int(rng.choice([8, 16, 32, 64, 128, 256]))
            at = int(rng.integers(0, max(1, len(text) - size + 1)))
            piece = text[at : at + size]
            if ASCII_LETTER.search(piece):
                x.append(piece.ljust(WINDOW, b"\0"))
                y.append(label)
    return np.frombuffer(b"".join(x), np.uint8).reshape(-1, WINDOW), np.array(y, np.int64)


def learn(docs: DataFrame, allowed: Column | None = None, per_language: int = 400, max_bytes: int = 16_384, rows: int = 80_000) -> ByteNet | None:
    """Train on a bounded sample of at most ``rows`` labelled rows.

    Of every language, up to ``per_language`` documents that are not empty, the first by a hash of their id; fewer of each where there
    are more than ``rows / per_language`` languages, so a rare one is learned too (only of more than ``rows`` languages some are not). Of
    a text with more than ``max_bytes / 4`` characters a piece of that length is taken,
    from a place that the id's hash picks, so a language of long texts only is learned too. Rows of one id and language teach once, the smallest piece. ``allowed`` says which rows may be used.
    """
    allowed = F.lit(True) if allowed is None else allowed
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & allowed)
    usable = usable.filter(F.octet_length("text") > 0)
    found = usable.select(F.count_distinct("lang")).first()[0]
    if not found:
        return None
    each = max(1, min(per_language, rows // found))
    window = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")  # a limit per group: pruned before the shuffle
    ids = usable.select("doc_id", "lang").withColumn("_n", F.row_number().over(window))
    picked = ids.filter(F.col("_n") <= each).select("doc_id", "lang").distinct()
    if found > rows:
        picked = picked.orderBy(F.xxhash64("lang"), "lang").limit(rows)
    size = max(max_bytes // 4, 1)
    start = 1 + F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - size + 1, F.lit(1)))
    pieces = usable.select("doc_id", "lang", F.substring("text", start.cast("int"), F.lit(size)).alias("text"))
    taught = pieces.join(F.broadcast(picked), ["doc_id", "lang"], "left_semi")  # at most ``rows`` ids
    taught = taught.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    taught.sort(key=lambda r: (r["doc_id"], r["lang"], r["text"]))
    names = sorted({r["lang"] for r in taught})
    if not names:
        return None
    x, y = training_windows([r["text"].encode("utf-8", "replace") for r in taught], [names.index(r["lang"]) for r in taught])
    if not len(x):
        return None
    return ByteNet.new(names).train(x, y)


def has_letter(text: bytes) -> bool:
    if ASCII_LETTER.search(text):
        return True
    return any(c.isalpha() for c in text.decode("utf-8", "replace")) if not text.isascii() else False


def predictor(net: ByteNet | None):
    """Function list of texts -> list of (language, probability)."""

    def predict(texts: list[bytes | None]) -> list[tuple[str, float]]:
        out = [(UNKNOWN, 0.0)] * len(texts)
        known = [i for i, t in enumerate(texts) if net is not None and t and has_letter(t)]
        if known:
            best, p = net.predict([texts[i] for i in known])
            for i, b, q in zip(known, best.tolist(), p.tolist()):
                out[i] = (net.languages[b], q)
        return out

    return predict


def identify_language(docs: DataFrame, net: ByteNet | None, rows: int = 64) -> DataFrame:
    """doc_id, predicted language and its probability for every row."""
    schema = "doc_id bigint, lang_pred string, score double"
    fields = arrow_schema(schema)

    def run(batches):
        predict = predictor(net)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                ids, texts = batch.slice(at, rows).columns
                found = predict(texts.to_pylist())
                yield pa.RecordBatch.from_arrays([ids, pa.array([f[0] for f in found]), pa.array([f[1] for f in found])], schema=fields)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(run, schema)


def keep_known_languages(docs: DataFrame, languages: list[str] | None = None, rows: int = 64) -> DataFrame:
    """Rows whose predicted language is one of ``languages``.

    By default all learned ones count: then only texts without letters are dropped, since every text with
    letters gets a learned language, also noise and unknown scripts; so it is, too, when there is nothing to learn from.
    """
    net = learn(docs)
    wanted = languages

    def run(batches):
        predict = predictor(net)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                texts = part.column(part.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
                if net is None and wanted is None:
                    keep = [bool(t) and has_letter(t) for t in texts]
                else:
                    keep = [f != UNKNOWN and (wanted is None or f in wanted) for f, _ in predict(texts)]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = remainder("doc_id", 5) == 0
    found = identify_language(docs, learn(docs, ~held))
    return found.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
