"""Toxicity by compression distance.

Two zstandard dictionaries are made, not trained by zstandard on running text: such dictionaries, with windows of many
words, do little better than chance here (the README has the figures). The toxic one holds the segments that set toxic text apart:
starting from byte 5-grams that are significantly more frequent in toxic documents, the one in most documents
is grown while its neighbours agree, its words are taken out, and so on until no gram is left. The
ordinary one holds every piece of those segments that ordinary text uses too. The toxic dictionary
ends with the same pieces, so that an ordinary window compresses alike with either, and what the
toxic one saves is evidence. A document is cut into windows (one word with its borders; longer runs in
overlapping pieces), each compressed with both dictionaries. Windows are written in two bytes per
character, so a five-letter match outweighs the fixed cost of a match.

Calibration uses labelled documents that the calibrated dictionaries have not seen (those in use are then
trained on all examples): a logistic model of the largest
saving and of the number of windows above the level that tells the labels apart best.

Nulls, ties and edge cases: a null or empty text has no window and gets the score of a document without
evidence; a null label, or one of a document that is not there, is not used; of several labels of a
document the largest counts; without toxic or ordinary examples all scores are 0. Columns besides
``doc_id`` and ``text`` are ignored, and repeated rows are scored one by one.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickframe.llm.common import give_back, map_rows, table
from wickframe.llm.memo import Memo

GRAM = 5  # bytes of the grams that segments grow from
RATIO = 5.0  # a gram's document frequency in toxic against ordinary text, at least
DEVIATES = 5.0  # deviations by which its toxic documents exceed what ordinary text lets expect
WIDTH, STEP = 48, 32  # characters of a window cut from a longer run
PAD = "\n" * 16
EDGES = b".,!?;:*#&%$\"'()[]|"


@dataclass(frozen=True)
class ToxicityModel:
    """Dictionaries and calibration; ``cut`` is the saving that counts as evidence."""

    toxic: bytes
    ordinary: bytes
    cut: int
    weights: tuple[float, float, float]

    def scorer(self):
        """Function text bytes -> (score, largest saving, windows with evidence)."""
        save = Memo(_saving(self.toxic, self.ordinary), 120_000)
        w0, w1, w2 = self.weights
        cut = self.cut

        def score(text: bytes | None) -> tuple[float, int, int]:
            found = [save[w] for w in windows(text or b"")]
            best = max(found, default=0)
            hits = sum(1 for s in found if s >= cut) if best >= cut else 0
            x = w0 + w1 * best + w2 * math.log1p(hits)
            return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, x)))), best, hits

        return score


def windows(text: bytes) -> list[bytes]:
    """Words without their outer punctuation; runs beyond ``WIDTH`` in overlapping pieces."""
    words = text.lower().split()
    if not any(len(w) > WIDTH for w in words):
        return words
    out = []
    for w in words:
        if len(w) <= WIDTH:
            out.append(w)
        else:
            out += [w[i : i + WIDTH] for i in range(0, len(w) - WIDTH + STEP, STEP)]
    return out


def _wide(text: str) -> bytes:
    return text.encode("utf-16-le", "replace")


def _saving(toxic: bytes, ordinary: bytes):
    def compressor(content: bytes):
        params = zstandard.ZstdCompressionParameters.from_level(
            3, strategy=zstandard.STRATEGY_GREEDY, min_match=6, hash_log=12, chain_log=12, search_log=6, window_log=14,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress

    with_toxic, with_ordinary = compressor(toxic), compressor(ordinary)

    def saving(word: bytes) -> int:
        window = _wide(PAD + " " + word.strip(EDGES).decode("utf-8", "replace") + " ")
        return len(with_ordinary(window)) - len(with_toxic(window))

    return saving


def _bare(text: bytes) -> set[bytes]:
    return {b" " + w.strip(EDGES) + b" " for w in windows(text)}


def contrast_segments(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Byte strings that set toxic documents apart, the most frequent first."""
    toxic = without_copies(toxic)
    docs: dict[bytes, set[int]] = defaultdict(set)
    for i, text in enumerate(toxic):
        for w in _bare(text):
            docs[w].add(i)
    usual: Counter = Counter()
    for text in ordinary:
        usual.update({w[i : i + GRAM] for w in _bare(text) for i in range(len(w) - GRAM + 1)})
    holders: dict[bytes, set[bytes]] = defaultdict(set)
    for w in docs:
        for i in range(len(w) - GRAM + 1):
            holders[w[i : i + GRAM]].add(w)

    def weight(gram: bytes) -> int:
        return len(set().union(*(docs[w] for w in holders[gram]))) if holders[gram] else 0

    def stands_out(gram: bytes, n: int) -> bool:
        expected = (usual[gram] + 0.5) / (len(ordinary) + 1) * len(toxic)
        return n >= RATIO * expected and n - expected >= DEVIATES * math.sqrt(expected + 1)

    grams = {g: n for g in holders if stands_out(g, n := weight(g))}
    out = []
    while grams:
        best = max(grams, key=lambda g: (grams[g], g))
        words = holders[best]
        segment = _grow(best, {w: len(docs[w]) for w in words})
        out.append(segment)
        gone = [w for w in docs if segment in w or best in w]
        touched = set()
        for w in gone:
            for i in range(len(w) - GRAM + 1):
                holders[w[i : i + GRAM]].discard(w)
                touched.add(w[i : i + GRAM])
            del docs[w]
        for g in touched & grams.keys():
            n = weight(g)
            if stands_out(g, n):
                grams[g] = n
            else:
                del grams[g]
        grams.pop(best, None)
    return out


def without_copies(texts: list[bytes], hashes: int = 4) -> list[bytes]:
    """Of texts that share a smallest run of four words under one of a few hash functions, the first.

    A group of near copies would otherwise pass its own words off as frequent ones.
    """
    seen: set[tuple[int, int]] = set()
    out = []
    for text in texts:
        words = windows(text)
        runs = {b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))}
        keys = {(i, min(zlib.crc32(r, i) for r in runs)) for i in range(hashes)}
        if words and not keys & seen:
            out.append(text)
        seen |= keys
    return out


def _grow(segment: bytes, words: dict[bytes, int]) -> bytes:
    """Extend while nine tenths of the occurrences share the next byte on a side."""
    while True:
        for left in (True, False):
            near: Counter = Counter()
            for w, n in words.items():
                p = w.find(segment)
                if p >= 0:
                    near[w[max(p - 1, 0) : p] if left else w[p + len(segment) : p + len(segment) + 1]] += n
            byte, n = near.most_common(1)[0] if near else (b"", 0)
            if byte and n >= 0.9 * sum(near.values()):
                segment = byte + segment if left else segment + byte
                break
        else:
            return segment


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes, list[str]]:
    """Contents of the toxic and the ordinary dictionary, and the segments."""
    segments = [s.decode("utf-8", "ignore") for s in contrast_segments(toxic, ordinary)]
    usual = b"".join(w for text in ordinary for w in sorted(_bare(text))).decode("utf-8", "replace")
    pieces: set[str] = set()
    for s in segments:
        for k in range(len(s) - 1, 2, -1):
            pieces |= {p for i in range(len(s) - k + 1) if (p := s[i : i + k]) in usual and not any(p in q for q in pieces)}
    shared = "".join(p + "\n" for p in sorted(pieces)) + PAD
    return _wide("".join(s + "\n" for s in segments) + shared), _wide(shared), segments


def calibrate(toxic: bytes, ordinary: bytes, examples: list[tuple[bytes, int]], prior: float = 0.5) -> tuple[int, tuple[float, float, float]]:
    """Saving that counts as evidence, and logistic weights (intercept, largest saving, log count).

    The examples of a class weigh as much together as ``prior``, the share of toxic labels, says.

    Of all levels of evidence the one that makes the labels likeliest is taken, the lowest of equals.
    """
    save = Memo(_saving(toxic, ordinary))
    found = [[save[w] for w in windows(text)] for text, _ in examples]
    y = np.array([label for _, label in examples], float)
    part = np.where(y == 1, prior / max(y.sum(), 1), (1 - prior) / max((1 - y).sum(), 1)) * len(y)
    tops = [max(s, default=0) for s in found]
    best = None
    for cut in range(1, max(2, min(max(tops, default=1), 12) + 1)):
        x = np.array([[1.0, top, math.log1p(sum(v >= cut for v in s))] for s, top in zip(found, tops)])
        weights, loss = _fit(x, y, part)
        if best is None or loss < best[0] - 1e-9:
            best = loss, cut, weights
    return best[1], tuple(float(v) for v in best[2])


def _fit(x: np.ndarray, y: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic weights with a small penalty, by Newton's method, and their loss."""
    w, ridge = np.zeros(3), np.array([1e-3, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (part * (y - p)) - ridge * w
        hess = (x * (part * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    z = np.clip(x @ w, -30, 30)
    return w, float((part * (np.logaddexp(0, z) - y * z)).sum() + (ridge * w * w).sum() / 2)


def learn(
    docs: DataFrame, labels: DataFrame, allowed: Column | None = None, n_toxic: int = 1_500, n_ordinary: int = 2_500, max_bytes: int = 16_384
) -> ToxicityModel | None:
    """Train on a bounded sample of labelled rows.

    At most ``n_toxic`` and ``n_ordinary`` documents of at most ``max_bytes`` bytes, the first by a
    hash of their id; dictionaries of two thirds are calibrated on the rest, then trained on all. ``allowed`` says
    which documents may be used at all (default: each).
    """
    allowed = F.lit(True) if allowed is None else allowed
    known = labels.select("doc_id", "toxic").filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & allowed)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    share = known.agg(F.avg((F.col("_toxic") == 1).cast("double"))).first()[0]
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    short = docs.filter(F.col("text").isNotNull() & (F.octet_length("text") <= max_bytes) & allowed).select("doc_id", "text")
    rows = []
    for label, n in ((1, n_toxic), (0, n_ordinary)):
        picked = known.filter(F.col("_toxic") == label).orderBy(*order).limit(2 * n)
        got = short.join(F.broadcast(picked), "doc_id").orderBy(*order, "text").limit(n)  # at most 2 n ids
        rows += [(r["text"].encode("utf-8", "replace"), label) for r in got.collect()]
    train, held = [r for i, r in enumerate(rows) if i % 3], rows[::3]
    toxic, ordinary = [t for t, y in train if y == 1], [t for t, y in train if y == 0]
    if not toxic or not ordinary or len({y for _, y in held}) < 2:
        return None
    with_toxic, with_ordinary, _ = train_dictionaries(toxic, ordinary)
    cut, weights = calibrate(with_toxic, with_ordinary, held, share)
    with_toxic, with_ordinary, _ = train_dictionaries([t for t, y in rows if y == 1], [t for t, y in rows if y == 0])
    return ToxicityModel(with_toxic, with_ordinary, cut, weights)


def score_toxicity(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``docs`` ids with score (0 to 1), largest saving in bytes and windows with evidence."""
    schema = "doc_id bigint, score double, best_saving int, n_hits int"

    def make():
        if model is None:
            return lambda row: [(row[0], 0.0, 0, 0)]
        score = model.scorer()
        return lambda row: [(row[0], *score(row[1]))]

    return map_rows(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")), schema, make)


def remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(column).cast("string")) % n


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs, labels, remainder("doc_id", 4) != 2)
    out = score_toxicity(docs, model)
    return out.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "best_saving",
        "n_hits",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` whose score stays below ``threshold``; no shuffle of texts.

    The score rides along with its row, so repeated or null ids cannot mix rows up.
    """
    model = learn(docs, labels)
    if model is None:
        return docs

    import pyarrow as pa

    def run(batches):
        score = model.scorer()
        for b in batches:
            texts = b.column(b.schema.get_field_index("text"))
            keep = [score(t.as_py().encode("utf-8", "replace") if t.is_valid else None)[0] < threshold for t in texts]
            yield b.filter(pa.array(keep, pa.bool_()))
        del score
        give_back()

    return docs.mapInArrow(run, docs.schema)
