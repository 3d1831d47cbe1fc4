"""Training-data operators against plain versions, SQL, round trips and held-out labels."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
import xxhash
from oracle_check import duck, rows_of
from tokenizers import Tokenizer

import __spark_entry__ as entry
from wickframe.llm import byte_bpe, embedding_dedup, language, packing, sharding, simhash, toxicity, url_filter, warc, winnowing
from wickframe.llm.components import connected_components

SF = "/root/testdata/sf0.01"
ODD = ["", " ", "\n\t", "word", "Two Words", "a\x1cb c\x85d", "中文 テスト", "don't. x,y", "é́ Å", "<|endoftext|> and <|ENDOFTEXT|>", "x" * 5000, "ab " * 3000]


def documents():
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' where doc_id < 400 order by 1").fetchall()
    texts = [t for _, t in rows] + ODD + ODD[:4] + [rows[0][1] + " more", None, None]
    return [(i * 3, t, "en", "s", 7) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), "doc_id long, text string, lang string, fp string, part long")


def plain_components(n, edges):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 480)] + [(500, i) for i in range(501, 560)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = plain_components(600, edges)
    assert all(got.get(i, i) == want[i] for i in range(600))
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash(docs):
    def plain(text):
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        grams = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    rows = documents()
    prints = [plain(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2]
    want = plain_components(len(rows), links)
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.simhash_components(docs).collect()}
    assert got == {r[0]: (prints[i], rows[want[i]][0]) for i, r in enumerate(rows)}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({rows[w][0] for w in want})


def test_near_copies_beyond_pairs(spark):
    """Many fingerprints in one ball: one component, and no more rows than neighbours."""
    base = 0x0123456789ABCDEF
    near = {base} | {base ^ 1 << i for i in range(64)} | {base ^ 1 << i ^ 1 << j for i in range(20) for j in range(i)}
    fp = spark.createDataFrame([(i, f - 2**64 if f >= 2**63 else f) for i, f in enumerate(sorted(near))] + [(9999, ~base - 2**64 if ~base >= 2**63 else ~base)], "doc_id long, fp long")
    got = simhash.component_of(fp).collect()
    assert sorted({r.component_id for r in got}) == [0, 9999]


def test_packing(docs):
    rows = documents()
    tok = Tokenizer.from_file(packing.word_tokenizer())
    pieces, filled = defaultdict(list), defaultdict(int)
    got = packing.pack_documents(docs, packing.word_tokenizer(), with_ids=True, shard_tokens=60_000).collect()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id] and r.length == len(r.ids) > 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        filled[r.sequence_id] += r.length
        pieces[r.doc_id].append((r.start, r.ids, r.doc_tokens))
    assert all(n <= 2048 and n & (n - 1) == 0 for n in filled.values())
    for key, text, *_ in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        parts = sorted(pieces[key])
        assert [i for p in parts for i in p[1]] == ids and all(p[2] == len(ids) for p in parts)
        assert [p[0] for p in parts] == np.cumsum([0] + [len(p[1]) for p in parts[:-1]]).tolist()


def test_piecewise_tokens_are_exact():
    rng = random.Random(5)
    letters = [chr(c) for c in [*range(1, 128), 0x85, 0xA0, 0x300, 0x301, 0x307, 0x130, 0x131, 0x2003, 0xDF, 0xE9, 0x1E9E, 0x3A3, 0x212A]]
    texts = ODD + ["".join(rng.choice(letters) for _ in range(50)) for _ in range(1500)]
    tok, enc = Tokenizer.from_file(packing.word_tokenizer()), packing.PieceEncoder(packing.word_tokenizer())
    for t, raw in zip(texts, enc.encode([t.encode() for t in texts])):
        assert np.frombuffer(raw, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_scores_are_bm25():
    """The index of a shard against BM25 written out, document by document."""
    enc = packing.PieceEncoder(packing.word_tokenizer())
    ids = [np.frombuffer(e, "<u4").tolist() for e in enc.encode([(r[1] or "").encode() for r in documents()[:120]])]
    shard, n = packing.Shard([np.array(d, "<u4") for d in ids]), len(ids)
    average = sum(map(len, ids)) / n
    df = Counter(t for d in ids for t in set(d))
    counts = [Counter(d) for d in ids]
    for q in range(0, n, 20):
        got = shard.scores(q)
        for i, d in enumerate(ids):
            want = 0.0
            for t in set(ids[q]) & set(d):
                if df[t] > 1:
                    norm = packing.K1 * (1 - packing.B + packing.B * len(d) / average)
                    want += math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * counts[i][t] * (packing.K1 + 1) / (counts[i][t] + norm)
            assert i == q or got[i] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_packing_finds_neighbours_anywhere(spark):
    """Forty subjects of ten documents, dealt so that no run of forty documents has one twice."""
    rng = random.Random(3)
    words = re.findall("[a-z]{4,}", " ".join(r[1] or "" for r in documents()[:300]))
    subjects = [rng.sample(sorted(set(words)), 25) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(subjects[i % 40]) for _ in range(80))) for i in range(400)]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), packing.word_tokenizer(), shard_tokens=10_000).collect()
    windows = defaultdict(set)
    for r in got:
        windows[r.sequence_id].add(r.doc_id)
    pairs = [a % 40 == b % 40 for w in windows.values() for a in w for b in w if a < b]
    assert {r.doc_id for r in got} == set(range(400)) and np.mean(pairs) > 0.4


def test_frequent_terms_are_scored_at_once():
    """Postings of frequent terms are not searched, and the scores are those of a search of all postings."""
    rng = np.random.default_rng(5)
    docs = [np.append(rng.zipf(1.3, rng.integers(1, 80)) % 500 + 2, 1).astype("<u4") for _ in range(200)]
    shard, plain = packing.Shard(docs), packing.Shard(docs)
    plain.rare, plain.common = plain.df > 1, np.zeros((0, 0))
    assert shard.df[shard.rare].sum() < plain.df[plain.rare].sum() / 2
    assert all(np.array_equal(shard.scores(i), plain.scores(i)) for i in range(200))
    assert list(shard.order(100)) == list(plain.order(100))


def test_terms_are_counted_together():
    rng = np.random.default_rng(6)
    docs = [rng.integers(0, 300, n).astype("<u2") for n in (1, 40, 3, 500)]
    sizes = pa.array([len(d) for d in docs])
    for kind in ("<u2", "<u4"):
        starts, ids = packing.ids_of(sizes, pa.array([d.astype(kind).tobytes() for d in docs], pa.binary()))
        row, term, tf = packing.count_terms(starts, ids)
        assert list(zip(row.tolist(), term.tolist(), tf.tolist())) == [(i, t, n) for i, d in enumerate(docs) for t, n in sorted(Counter(d.tolist()).items())]


def test_packing_drops_postings_of_used_documents():
    """The order is that of a search over all postings, and the index shrinks on the way."""
    rng = random.Random(3)
    docs = [np.array([rng.randint(2, 60) for _ in range(rng.randint(1, 50))] + [1], "<u4") for _ in range(300)]
    whole, seed, filled, want = packing.Shard(docs), None, 0, []
    while len(want) < len(docs):
        opens = seed is None
        if opens:
            seed = next(i for i in range(len(docs)) if i not in want)
            near = [seed]
        else:
            found = whole.scores(seed)
            near = [i for i in np.argsort(-found, kind="stable").tolist() if found[i] > 0 and i not in want]
        for i in near:
            want.append(i)
            filled += len(docs[i])
            if filled >= 100:
                filled %= 100
                fresh = i if filled else None
                break
        else:
            fresh = seed if opens else None
        seed = fresh
    shard = packing.Shard(docs)
    postings = len(shard.doc)
    assert list(shard.order(100)) == want
    assert len(shard.doc) < postings / 2


def test_byte_bpe(docs):
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    args = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    tokens = byte_bpe.encode_documents(docs, *args)
    got = {r.doc_id: r.ids for r in tokens.collect()}
    assert all(got[r[0]] == own.encode_ordinary(r[1] or "") for r in documents())
    back = {r.doc_id: bytes(r.text) for r in byte_bpe.decode_documents(tokens, *args).collect()}
    assert all(back[r[0]] == (r[1] or "").encode() for r in documents())
    table = byte_bpe.PerfectHash(list(ranks))
    assert sorted(table.index(list(ranks)).tolist()) == list(range(len(ranks)))


def test_byte_bpe_merges_side_by_side():
    """Pieces of all widths, ties and overlaps included, as the linked list and heap merge them; one lookup for all texts."""
    bpe = byte_bpe.ByteBpe(byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    rng = random.Random(5)
    raws = [bytes(rng.choice(b"etaoin sh\xc3\xa9\x00\xff") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    raws += [c * n for c in (b"a", b"th", b"\xff") for n in range(70)]
    assert bpe.merge_all(raws) == [bpe.merge(r) for r in raws]
    texts = [" ".join(rng.choice("thaeion") * rng.randint(1, 9) + str(i) for _ in range(20)) for i in range(50)]
    calls, lookup = [], bpe.hash.index
    bpe.hash.index = lambda keys: calls.append(len(keys)) or lookup(keys)
    together = bpe.encode_all(texts)
    assert len(calls) == 1
    assert together == [bpe.encode(t) for t in texts]


def test_winnowing(docs):
    def plain(text, k=winnowing.K, w=winnowing.W):
        h, out = winnowing.gram_hashes(text, k).tolist(), []
        for i in range(max(len(h) - w + 1, 1) if h else 0):
            part = h[i : i + w]
            at = i + max(j for j, v in enumerate(part) if v == min(part))
            if not out or out[-1][1] != at:
                out.append((h[at], at))
        return out

    for text in ODD + [documents()[0][1], "ab" * 200]:
        assert list(zip(*(x.tolist() for x in winnowing.winnow(text)))) == plain(text)
    h = winnowing.gram_hashes("0123456789abcdefgh|0123456789abcdefgh")
    assert h[0] == h[19] and h[1] == h[20]
    rows = documents()
    got = {r.doc_id: r for r in winnowing.compare_edits(docs).collect()}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        text, after = r[1] or "", rows[(i + 1) % len(rows)][1] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        have = got[r[0]]
        assert have.n_chars == len(text) and have.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert have.fingerprint == winnowing.digest(*winnowing.winnow(text))
        assert (have.near_edited == 1.0) if text == edited else 0 <= have.near_edited <= 1


def test_language(spark):
    found = entry.queries()["op10_language"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    net = language.ByteNet.new(["a", "b"])
    assert [p[0] for p in language.predictor(net)([None, b"", b"123 !", "ж".encode()])][:3] == ["und"] * 3


def test_toxicity(spark):
    """Held-out labels at sf0.1; measured there: 0.82 of the toxic documents found, 0.008 of the others flagged (see README)."""
    folder, recall, false = "/root/testdata/sf0.1", 0.8, 0.015
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = toxicity.op2_toxicity(spark, folder).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(toxic) / len(toxic) >= recall and sum(clean) / len(clean) <= false


def test_odd_texts(spark):
    odd = spark.createDataFrame([(1, None, 1), (2, "", 2), (2, "", 2), (None, "x" * 9000, 3)], "doc_id long, text string, score int")
    model = toxicity.ToxicityModel(b"abc", b"abc", 1, (-3.0, 1.0, 1.0))
    got = toxicity.score_toxicity(odd, model).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize("name", ["op1_embedding_dedup", "op6_url_filter", "op9_sharding"])
def test_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    rel = duck(SF).execute(entry.oracle_sql()[name])
    columns = [d[0] for d in rel.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, rel.fetchall())


def test_sharding_splits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.shard, r.shard_bytes, r.fits) for r in sharding.assign_shards(docs, limit=20_000).collect()}
    want = duck(SF).execute(sharding.sharding_sql(20_000)).fetchall()
    assert got == {r[0]: (r[2], r[4], r[5]) for r in want} and len({v[0] for v in got.values()}) > 100
    one = spark.createDataFrame([(7, "x" * 100)] * 30 + [(None, None)], "doc_id long, text string")
    rows = sharding.directory(sharding.assign_shards(one, limit=500)).collect()
    assert sorted((r.n_docs, r.fits) for r in rows) == [(1, True), (30, False)]


def test_sharding_splits_a_hot_key(spark, tmp_path):
    """A third of all rows under one key and many without any: split by content, as the SQL does; equal rows stay together."""
    rows = [(7, f"{i} " + "x" * (i % 90)) for i in range(300)] + [(None, f"null {i}") for i in range(100)] + [(i, "y" * 50) for i in range(100, 300)] + [(9, "z" * 100)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sharding.assign_shards(docs, limit=500).select("doc_id", "bytes", "shard", "depth", "shard_bytes", "fits")
    view = duckdb.connect()
    view.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    rel = view.execute(sharding.sharding_sql(500))
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of([d[0] for d in rel.description], rel.fetchall())
    found = got.collect()
    assert len(found) == len(rows) and {r.doc_id for r in found if not r.fits} == {9}
    assert len({r.shard for r in found if r.doc_id == 7}) > 10


def test_sharding_query_splits(spark):
    parts = sharding.directory(sharding.op9_sharding(spark, SF)).collect()
    assert len(parts) >= 24 and sum(r.n_docs for r in parts) == 1000


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/x", "http://net", "http://net/", "http://example.com/de/1?x#y", "http://x.org/fr/", "http://notnet.com/a/b/c/d/e", "x://h#f", "http://h?q=/net/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert got[0] == got[1] == got[2] and got[0][:3] == ("", "", None)
    assert got[3] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[4][:3] == ("net", "", None) and got[5] == ("net", "/", "net/", "block")
    assert got[6] == ("example.com", "/de/1", "example.com/de/", "block") and got[7][2:] == ("org/fr/", "allow")
    assert got[9][:2] == ("h", "") and got[10][:2] == ("h", "")


def test_urls_of_a_large_host(spark):
    """Hundreds of first segments on one host: the frequent blocked branch stays apart from the clean ones."""
    urls = [f"http://big.example.com/de/{'abcdefghij'[i % 10]}" for i in range(3000)]
    names = ["".join("abcdefghij"[int(c)] for c in f"{i:03}") for i in range(400)]
    urls += [f"http://big.example.com/{names[i % 400]}/x" for i in range(2000)]
    got = url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    assert all(r.template.startswith("/de/") == (r.page_id < 3000) for r in got)
    assert all(r.verdict == ("block" if r.page_id < 3000 else "allow") for r in got)


def test_urls_of_deep_branches(spark, tmp_path):
    """Rules and differences far below the root, paths that end inside others, unlabelled pages, hosts of one long path."""
    rules = (("block", "deep.org", "/a/b/c/bad/x"), ("allow", "deep.org", "/a/b/c/good/x"), ("block", "mix.org", "/s/q"))
    urls = [f"http://deep.org/a/b/c/{kind}/{leaf}" for kind in ("bad", "good") for leaf in [f"x{c}" for c in "abcdefghij" for _ in range(4)] + ["unlike"] * 20]
    urls += ["http://deep.org/a/b/c/bad/other", "http://deep.org/a/b/c/good/other", "http://deep.org/a/b", "http://deep.org/a/b/c/bad", "http://deep.org", "http://deep.org/" + "/".join("uv" * 20)]
    urls += [f"http://mix.org/s/{leaf}" for leaf in ("q", "r", "t") for _ in range(9)] + ["http://lone.org/" + "/".join("abc" * 30), None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, rules=rules).collect()}
    want = plain_templates(pages, rules)
    assert len(got) == len(urls)
    assert {i: (r.template, r.purity) for i, r in got.items()} == want
    judged = {urls[i]: r.verdict for i, r in got.items() if r.rule is None}
    assert judged["http://deep.org/a/b/c/bad/other"] == "block" and judged["http://deep.org/a/b/c/good/other"] == "allow"
    assert judged["http://deep.org/a/b/c/bad/unlike"] == "allow"  # frequent, and unlike the blocked branches beside it
    assert judged["http://lone.org/" + "/".join("abc" * 30)] == "allow"


def plain_templates(pages, rules):
    """The tree walked segment by segment, one host after the other."""
    host, path = url_filter.split_url(url_filter.F.col("url"))
    name, action = url_filter.matching_rule(host, path, rules)
    rows = pages.select("page_id", host, url_filter.path_shape(path), action).collect()
    hosts, templates = defaultdict(list), {}
    for i, h, shape, act in rows:
        hosts[h].append((i, [s for s in shape.split("/") if s], act))

    def walk(members, depth, template):
        branches = defaultdict(list)
        for m in members:
            branches[m[1][depth] if depth < len(m[1]) else ""].append(m)
        pn, pb = len(members), sum(m[2] == "block" for m in members)
        merged = []
        for seg, part in branches.items():
            n, b = len(part), sum(m[2] == "block" for m in part)
            alike = pb in (0, pn) or (b * (pn - n) - (pb - b) * n) ** 2 * pn < url_filter.Z2 * pb * (pn - pb) * n * (pn - n)
            if seg == "":
                templates.update((m[0], template) for m in part)
            elif alike and len(branches.keys() - {""}) > 1:
                merged += part
            else:
                walk(part, depth + 1, f"{template}/{seg}")
        if merged:
            walk(merged, depth + 1, f"{template}/**")

    out = {}
    for members in hosts.values():
        walk(members, 0, "")
        share = sum(m[2] == "block" for m in members) / len(members)
        seen = defaultdict(Counter)
        for m in members:
            seen[templates[m[0]]][m[2]] += 1
        for m in members:
            c = seen[templates[m[0]]]
            labelled = c["block"] + c["allow"]
            out[m[0]] = (templates[m[0]], round((c["block"] + 10 * share) / (labelled + 10), 9) if labelled else None)
    return out


def test_warc(spark, tmp_path):
    rows = [(i, f"http://h/{i}\n", "é" * (i % 7) if i % 5 else None, i) for i in range(300)] + [(None, None, "only", 1), (-4, "u", "x" * 400_000, 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, frame int")
    index = warc.write_bundles(pages, str(tmp_path), frame=2_000)
    got = {r.page_id: r for r in warc.read_bundles(index, str(tmp_path)).collect()}
    last = {}
    for r in rows:
        last[r[2] or ""] = max(last.get(r[2] or "", -(10**9)), -(10**9) if r[0] is None else r[0])
    for page_id, _, html, _ in rows:
        payload = (html or "").encode()
        have, first = got[page_id], last[html or ""]
        assert have.payload_bytes == len(payload) and have.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert have.refers_to == (None if page_id is None or page_id == first else first)
        assert have.record_type == ("response" if have.refers_to is None else "revisit")
    for r in warc.fetch_records(index.filter("page_id in (3, 299, -4)"), str(tmp_path)).collect():
        headers, block, end = warc.parse_record(bytes(r.record))
        assert end == len(r.record) and warc.read_record(headers, block)[0] == r.page_id


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0], 1)]
    rows += [(8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [], 1), (12, [0.93, (1 - 0.93**2) ** 0.5 - 1e-6], 1), (13, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert [got[i] for i in (1, 2, 3, 12)] == [(3, 1, True), (3, 1, False), (3, 1, False), (3, 1, False)]
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 13)) and got[None] == (0, None, False)


def test_vectors_with_repeated_ids_and_text_labels(spark):
    """Rows of one id with different vectors or labels keep apart; labels of several types."""
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.01], "a"), (2, [0.0, 1.0], "a"), (3, [0.01, 1.0], "a"), (2, [1.0, 0.0], "b"), (4, [1.0, 0.01], "b")]
    for kind, name in (("string", str), ("long", lambda x: 2**40 + ord(x)), ("binary", lambda x: bytes([200, ord(x)]))):
        data = spark.createDataFrame([(i, v, name(x), "k", 1) for i, v, x in rows], f"vec_id long, embedding array<float>, label {kind}, rep string, n int")
        got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.link_vectors(data).collect())
        assert got == [(1, 1, 1, True), (2, 1, 1, False), (2, 1, 2, True), (2, 1, 2, True), (3, 1, 2, False), (4, 1, 2, False)]


def test_vectors_against_all_pairs(spark):
    """Repeated ids, copies and near copies: links and components of each row from all pairs."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 6))
    rows = [(int(rng.integers(80)), (base[rng.integers(12)] + rng.normal(0, 0.22, 6)).astype(np.float32).tolist(), int(rng.integers(2))) for _ in range(150)]
    rows += [rows[0]] * 3 + [(99, rows[0][1], rows[0][2])]
    v = np.array([r[1] for r in rows])
    v /= np.sqrt((v * v).sum(1))[:, None]
    label = np.array([r[2] for r in rows])
    hit = (v @ v.T >= embedding_dedup.THRESHOLD) & (label[:, None] == label)
    np.fill_diagonal(hit, False)
    part = plain_components(len(rows), zip(*(x.tolist() for x in np.nonzero(hit))))
    least = {p: min(rows[i][0] for i in range(len(rows)) if part[i] == p) for p in part}
    want = sorted((r[0], int(hit[i].sum()), least[part[i]]) for i, r in enumerate(rows))
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.link_vectors(data, tile=16).collect())
    assert got == want and len({w[2] for w in want}) > 3


def test_clashing_columns(spark):
    rows = [(1, "one two three four", 5, 6), (2, "one two three four", 5, 6), (3, "five six seven eight", 7, 8), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key long, _KEY_ int")
    got = simhash.keep_first(docs)
    assert got.columns == docs.columns and sorted(tuple(r) for r in got.filter("doc_id is not null").collect()) == [rows[0], rows[2]]
    for key in ("bytes", "h", "s", "depth", "cell"):
        named = spark.createDataFrame([(1, "x" * 50), (2, "y" * 50), (None, None)], f"{key} long, text string")
        out = sharding.assign_shards(named, key=key, limit=60)
        assert sorted(r["bytes"] for r in out.collect()) == [0, 50, 50] and out.columns[0] == (f"{key}_key" if key in sharding.RESULT else key)


def test_language_of_long_texts_only(spark):
    """A language whose texts are all very long is learned; empty and null texts teach nothing."""
    rng = random.Random(4)
    kinds = {"aa": "abcde", "zz": "vwxyz"}
    rows = [(i, "".join(rng.choice(a + " ") for _ in range(300 if lang == "aa" else 60_000)), lang) for i, (lang, a) in enumerate(list(kinds.items()) * 12)]
    rows += [(900, "abc de", "aa")] * 30 + [(901, "", "ee"), (902, None, "nn")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language.learn(docs)
    assert net.languages == ["aa", "zz"]
    texts = ["edcba abc", "zyx wvv zzy"]
    assert [p[0] for p in language.predictor(net)([t.encode() for t in texts])] == ["aa", "zz"]


def test_languages_beyond_the_sample(spark):
    """More languages than the sample has rows for at full size: each is still learned."""
    docs = spark.createDataFrame([(i, f"word{i % 30} text", f"l{i % 30:02}", "s", 1) for i in range(300)], "doc_id long, text string, lang string, source string, n_chars long")
    assert len(language.learn(docs, rows=60).languages) == 30
    assert len(language.learn(docs, rows=10).languages) == 10


def test_language_stage_without_labels(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "123 !", None), (3, None, None), (4, "\u0436", None)], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in language.keep_known_languages(docs).collect()) == [1, 4]
