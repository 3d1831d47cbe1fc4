"""Collocations, periodic runs and pair-index BPE against plain versions."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from wickframe.llm import collocations as col
from wickframe.llm import pair_bpe, periodic_runs, words

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 3000), (4, "a " * 3000), (None, "x y x y x y x y"), (6, "Ünï Σ ΑΣ <|endoftext|> don't")]


def frame(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    wide = [(i, t, None, t, 1, 2, 3, 4) for i, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, chunk string, freq int, size int, runs int, ids int")


# collocations


def plain_collocations(docs, least, top=2000):
    import re

    counts, words = {}, Counter()
    for lang, text in docs:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            ws = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(ws)
            for k in (1, 2, 3):
                for i in range(len(ws) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(ws[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in cand.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in cand.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def mined(df):
    return sorted(tuple(r[c] for c in ("grp", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize("window", [1 << 21, 60])
def test_collocations_brute_force(spark, monkeypatch, window):
    monkeypatch.setattr(col, "WINDOW", window)
    rng = random.Random(window)
    words = ["a", "B", "b", "été", "ÉTÉ", "x1", "of", "the", "-"]
    docs = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", "!? "]) for _ in range(rng.randint(0, 60)))
        docs.append((rng.choice(["en", "de", None, "und"]), text))
    docs += [("en", "the x1 of the x1 of")] * 30 + [("en", None), ("fr", ""), ("fr", "...")]
    df = spark.createDataFrame([(t, g, "c", 1) for g, t in docs], "text string, lang string, phrase string, n int").repartition(5)
    assert mined(col.collocations(df, least=3, top=40)) == plain_collocations(docs, 3, 40)


def test_collocations_empty(spark):
    assert col.collocations(frame(spark, [])).count() == 0
    assert col.collocations(frame(spark, [(1, None), (2, ". ! ?")])).count() == 0


def test_chunks_own_every_token_once():
    rng = random.Random(5)
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c", b"."]) for _ in range(rng.randint(1, 50))]
        parts = list(col.chunks(words, col._Hashes(), spacing=3))
        assert [w for c in parts for w in c.split(b" ")[:-2]] == words
        for one, two in itertools.pairwise(parts):
            assert one.split(b" ")[-2:] == (two.split(b" ") + [b".", b"."])[:2]
        assert sum(map(col.owned_words, parts)) == sum(w != b"." for w in words)


def test_packed_counts():
    h = np.array([0, 5, 2**40 - 1], np.uint64)
    n = np.array([1, 255, 10**12])
    a, b = col._unpack(col._pack(h, n))
    assert a.tolist() == h.tolist() and b.tolist() == n.tolist()


# periodic runs


def plain_runs(w, min_length=6, exponent=4):
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(min_length, exponent * q) and all(any(w[t] != w[t + p] for t in range(s, e - p)) for p in range(1, q)):
                out.append((s, e - s, q))
            i = j
    return sorted(out)


def repeated(rng, alphabet):
    words = []
    for _ in range(rng.randint(0, 6)):
        words += [str(rng.randrange(alphabet)) for _ in range(rng.randint(1, 8))] * rng.randint(1, 9)
    return words


@pytest.mark.parametrize("rule", [(6, 4), (4, 2), (9, 3)])
def test_runs_brute_force(spark, rule):
    rng = random.Random(rule[0])
    docs = [(i, " ".join(repeated(rng, rng.choice([1, 2, 3, 8])))) for i in range(300)]
    found = {r.doc_id: r for r in periodic_runs.periodic_runs(spark.createDataFrame(docs, "doc_id long, text string"), *rule).collect()}
    for i, text in docs:
        words = text.split()
        want = plain_runs(words, *rule)
        assert [(r.start, r.length, r.period) for r in found[i].runs] == want
        dropped = {t for s, n, q in want for t in range(s + q, s + n)}
        assert found[i].collapsed == " ".join(w for t, w in enumerate(words) if t not in dropped)
        assert found[i].n_words == len(words)


def test_extensions_of_the_grammar():
    rng = random.Random(8)
    for _ in range(40):
        seq = np.array([rng.randrange(rng.choice([1, 2, 3])) for _ in range(200)])
        g = periodic_runs.Grammar(seq, top=3)
        for _ in range(60):
            i, j = rng.sample(range(200), 2)
            k = next((k for k in range(200) if max(i, j) + k == 200 or seq[i + k] != seq[j + k]), 200)
            b = next((b for b in range(200) if min(i, j) == b or seq[i - b - 1] != seq[j - b - 1]), 200)
            assert (g.agree(i, j), g.agree(i, j, backwards=True)) == (k, b)


def test_runs_odd_rows(spark):
    rows = {}
    for r in periodic_runs.periodic_runs(frame(spark, ODD)).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert [len(rows[i]) for i in (1, 2, 3, 4, None, 6)] == [1, 1, 1, 2, 1, 1]
    assert all(rows[i][0].n_words == 0 and rows[i][0].runs == [] and rows[i][0].collapsed == "" for i in (1, 2, 3))
    assert all([(x.start, x.length, x.period) for x in r.runs] == [(0, 3000, 1)] and r.collapsed == "a" for r in rows[4])
    assert [(x.start, x.length, x.period) for x in rows[None][0].runs] == [(0, 8, 2)]
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0


def test_runs_query(spark, sf):
    docs = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    found = {r.doc_id: r for r in periodic_runs.op12_periodic_runs(spark, sf).collect()}
    assert len(found) == len(docs)
    for i, text in docs:
        w = (text or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(w)
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            w = [w[t] if t < a else w[a + (t - a) % p] for t in range(n)]
        runs = plain_runs(w)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        drop = {t for s, m, q in runs for t in range(s + q, s + m)}
        got = found[i]
        assert (got.n_runs, (got.start, got.length, got.period)) == (len(runs), best)
        assert got.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert got.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert got.collapsed_sha256 == hashlib.sha256(b" ".join(x for t, x in enumerate(w) if t not in drop)).hexdigest()


# reading of WARC bundles


def test_bundles_are_read_by_many_tasks(spark, tmp_path):
    from wickframe.llm import warc

    pages = spark.range(3000).selectExpr("id as page_id", "concat('http://a/', id) as url", "repeat(concat('x', id), 40) as html").coalesce(1)
    index = warc.write_bundles(pages, str(tmp_path), frame=2_000)
    assert index.select("bundle").distinct().count() == 1
    read = warc.read_bundles(index, str(tmp_path)).withColumn("task", F.spark_partition_id())
    rows = read.collect()
    assert sorted(r.page_id for r in rows) == list(range(3000))
    assert len({r.task for r in rows}) > 1
    got = warc.fetch_records(index.filter("page_id % 7 = 0").repartition(3), str(tmp_path)).collect()
    assert sorted(r.page_id for r in got) == list(range(0, 3000, 7))
    for r in got:
        headers, block, end = warc.parse_record(bytes(r.record))
        assert end == len(r.record) and warc.read_record(headers, block)[0] == r.page_id
    assert warc.read_bundles(index.filter("false"), str(tmp_path)).count() == 0


# pair-index BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_pair_index_equals_library(library):
    rng = random.Random(1)
    parts = ["a", "aa", "b", "ab", " ", "\t", "'", "s", "'S", "é", "é", "Σ", "ΑΣ ", "İ", "<|endoftext|>", "<|startoftext|>", "<|", "\x1c", "\x85",
             "\xa0", "日本", "한", "1", "½", "...", "\U0001f600", "‍", "ﬁ", "ẞ", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["a" * 5000, "abab" * 2000, "<|ENDOFTEXT|>", ""]
    bpe = pair_bpe.PairIndexBpe(PATH, memo=50)
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        for text, ids, want in zip(part, bpe.encode_all(part), library.encode_batch(part, add_special_tokens=False)):
            assert np.frombuffer(ids, "<u4").tolist() == want.ids, text
            assert bpe.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def test_words_of_small_letters_are_merged_together(library):
    """Only other words are split one by one; ids do not depend on the parts that texts come in."""
    rng = random.Random(2)
    letters = ["".join(rng.choice("etaoinéßüç") for _ in range(rng.choice((1, 5, 9, 14, 30, 41, 90)))) for _ in range(400)]
    texts = [" ".join(rng.choice(letters) + rng.choice(("", "", ".", ",")) for _ in range(50)) for _ in range(40)] + ["", "12 it's", "<|endoftext|> A.b", " "]
    bpe, split = pair_bpe.PairIndexBpe(PATH, memo=3), []
    plain = bpe._split
    bpe._split = lambda word: split.append(word) or plain(word)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(i, "<u4").tolist() for i in bpe.encode_all(texts)] == want
    assert {".", "12", "it's", "<|endoftext|>"} < set(split) and not any(w.isalpha() and w.islower() for w in split)
    for size in (1, 300):
        column = pa.array([None, *(t.encode() for t in texts)], pa.binary())
        got = [r for i, j in words.parts(column, size) for r in words.rows_of(bpe.encode_array(column.slice(i, j - i), b"\1\0\0\0"))]
        assert [np.frombuffer(r, "<u4").tolist() for r in got] == [[1], *([*w, 1] for w in want)]
    broken = pa.array([b"ab\xc3", b"\xa9a", b"\xff a"], pa.binary())  # no UTF-8: replaced, text by text
    assert words.rows_of(bpe.encode_array(broken)) == bpe.encode_all(["ab\ufffd", "\ufffda", "\ufffd a"])


def test_pair_index_query(spark, sf, library):
    docs = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    found = {r.doc_id: r for r in pair_bpe.op13_pair_bpe(spark, sf).collect()}
    assert len(found) == len(docs)
    for i, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pair_index_odd_rows(spark, library):
    encoded = pair_bpe.encode_documents(frame(spark, ODD), PATH)
    got = sorted((r.doc_id or 0, r.ids) for r in encoded.collect())
    assert got == sorted((i or 0, library.encode(t or "", add_special_tokens=False).ids) for i, t in ODD)
    back = sorted((r.doc_id or 0, r.text) for r in pair_bpe.decode_documents(encoded, PATH).collect())
    assert back == sorted((i or 0, library.decode(ids, skip_special_tokens=False)) for i, ids in got)
    assert pair_bpe.encode_documents(frame(spark, []), PATH).count() == 0
