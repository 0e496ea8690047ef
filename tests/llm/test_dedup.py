"""Duplicates, long repeats, archives, search and packing against brute force and round trips."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from onomast.llm import common, components, packing, recompress, repeats, simhash, suffix, topk, warc

# --- components and SimHash ---


def plain_components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, x) for x in range(2001, 2100)]
    want = plain_components([(a, b) for a, b in edges if a != b])
    df = spark.createDataFrame([*edges, (None, 1), (5, None), (7, 7)], "a long, b long")
    assert {x.node: x.component for x in components.components(df, "a", "b").collect()} == want
    assert components.components(df.limit(0), "a", "b").count() == 0


def plain_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _near_docs():
    r = random.Random(3)
    vocab = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(300)]
    docs, n = [], 0
    for group in range(25):
        base = [r.choice(vocab) for _ in range(r.choice([0, 2, 5, 60, 300]))]
        for _ in range(r.randint(1, 8)):
            words = list(base)
            for _ in range(r.randint(0, 2)):
                if words:
                    words[r.randrange(len(words))] = r.choice(vocab)
            docs.append((n, r.choice([" ", "\t", "\n "]).join(words)))
            n += 1
    return docs + [(n, None), (n + 1, ""), (n + 2, "\x0b \r"), (n + 3, "x " * 50_000), (0, docs[0][1]), (None, docs[3][1])]


def test_near_duplicates(spark):
    docs = _near_docs()
    fps = [plain_fingerprint(t) for _, t in docs]
    assert fps == [simhash.fingerprint(t) for _, t in docs]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, fp string")
    got = sorted(((x.doc_id, x.fp & (2**64 - 1), x.component_id) for x in simhash.near_duplicates(df).collect()), key=repr)
    assert got == plain_near_duplicates(docs)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def plain_near_duplicates(docs):
    """Every pair of rows, rows without an id too."""
    fps = [plain_fingerprint(t) for _, t in docs]
    group = plain_components([(a, b) for a in range(len(docs)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4])
    of = lambda k: group.get(k, k)
    least = {}
    for k, (i, _) in enumerate(docs):
        least.setdefault(of(k), [])
        least[of(k)] += [i] if i is not None else []
    return sorted(((i, f, min(least[of(k)], default=None)) for k, ((i, _), f) in enumerate(zip(docs, fps, strict=True))), key=repr)


def test_a_row_without_an_id_links_two_others(spark):
    r = random.Random(12)
    apart = lambda x, y: (plain_fingerprint(x) ^ plain_fingerprint(y)).bit_count()
    while True:
        a = [f"w{r.randrange(900)}" for _ in range(60)]
        b, c = list(a), list(a)
        b[r.randrange(60)] = "x"
        c[r.randrange(60)], c[r.randrange(60)] = "y", "z"
        a, b, c = map(" ".join, (a, b, c))
        if 0 < apart(a, b) <= 4 and 0 < apart(b, c) <= 4 < apart(a, c):
            break
    docs = [(1, a), (None, b), (2, c), (None, "nothing like it anywhere in this table of rows")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(((x.doc_id, x.fp & (2**64 - 1), x.component_id) for x in simhash.near_duplicates(df).collect()), key=repr)
    assert got == plain_near_duplicates(docs)
    assert sorted((x[0], x[2]) for x in got if x[0] is not None) == [(1, 1), (2, 1)]


@pytest.mark.parametrize("radius,segments", [(4, 2), (4, 3), (4, 4), (7, 4), (7, 3)])
def test_links_have_the_components_of_all_links(spark, radius, segments):
    r = random.Random(radius * 10 + segments)
    fps = set()
    for _ in range(30):
        f = r.getrandbits(64)
        for _ in range(r.choice([1, 3, 40, 120])):
            fps.add(f)
            f ^= 1 << r.randrange(64)
            if r.random() < 0.5:
                f ^= 1 << r.randrange(64)
    fps = sorted(fps)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    df = spark.createDataFrame([(s, i) for i, s in enumerate(signed)], "fp long, rep long")
    links = [(x.a, x.b) for x in simhash.links(df, radius, segments).collect()]
    assert all((fps[a] ^ fps[b]).bit_count() <= radius for a, b in links)
    every = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= radius]
    assert plain_components(links) == plain_components(every)


def test_large_buckets_send_forests():
    base = np.uint64(0x0123456789ABCDEF)
    fps = np.unique(base ^ (np.uint64(1) << np.arange(64, dtype=np.uint64)))
    a, b = simhash._forest(fps, 2)
    assert len(a) == len(fps) - 1 == len({*b})


def test_keep_one_each(spark):
    docs = spark.createDataFrame([(3, "a b c d e f g h", 1), (1, "a b c d e f g h", 1), (2, "q r s t u v w x y z", 1)], "doc_id long, text string, n int")
    assert sorted(x.doc_id for x in simhash.keep_one_each(docs).collect()) == [1, 2]


def test_join_by_hot_key(spark):
    left = spark.createDataFrame([(i, 0 if i % 3 == 0 else i) for i in range(300)], "id long, k long")
    right = left.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2).where("k <> 5")
    out = common.join_by_hot_key(left, right, "k", "n", 300).collect()
    assert sorted((x.id, x.k, x.v) for x in out) == sorted((i, k, None if k == 5 else 2 * k) for i in range(300) for k in [0 if i % 3 == 0 else i])


# --- long repeats ---


def plain_removed(docs, width):
    """Which tokens go, for (id, tokens); positions are ordered by id, then start."""
    first, gone = {}, []
    far = 1 << 62
    for d, tokens in docs:
        for s in range(len(tokens) - width + 1):
            w = tuple(tokens[s : s + width])
            at = (far if d is None else d, s)
            first[w] = min(first.get(w, at), at)
    for d, tokens in docs:
        marks = [False] * len(tokens)
        for s in range(len(tokens) - width + 1):
            if first[tuple(tokens[s : s + width])] < (far if d is None else d, s):
                marks[s : s + width] = [True] * width
        gone.append(marks)
    return gone


def _repeating_docs(seed, vocab, n=60):
    r = random.Random(seed)
    passages = [[r.choice(vocab) for _ in range(r.randint(3, 60))] for _ in range(8)] + [[vocab[0]] * 40, [vocab[0], vocab[1]] * 30, [vocab[2]] * 7]
    docs = []
    for i in range(n):
        words = []
        for _ in range(r.randint(0, 6)):
            words += r.choice(passages) if r.random() < 0.6 else [r.choice(vocab) for _ in range(r.randint(1, 30))]
        docs.append((i, words))
    docs.append((n, list(docs[5][1])))
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed,size", [(1, 4), (2, 30), (3, 2000)])
def test_words(spark, seed, size):
    docs = [(d, " ".join(w)) for d, w in _repeating_docs(seed, [f"w{i}é" for i in range(size)])]
    docs += [(900, None), (901, ""), (902, " \x0b\t "), (903, "long " * 30_000), (None, docs[0][1])]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_words int")
    got = {x.doc_id: x for x in recompress.remove_repeats(df).collect()}
    for (d, t), marks in zip(docs, plain_removed([(d, (t or "").split()) for d, t in docs], 20), strict=True):
        words = (t or "").encode().split()
        kept = b" ".join(w for w, m in zip(words, marks, strict=True) if not m)
        assert (got[d].n_words, got[d].n_removed, got[d].kept_sha256, got[d].kept) == (len(words), sum(marks), hashlib.sha256(kept).hexdigest(), kept.decode()), d
    assert recompress.remove_repeats(df.limit(0)).count() == 0


def test_rows_of_one_id(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(5)) + " " + " ".join(f"a{i}" for i in range(30))
    df = spark.createDataFrame([(1, a), (1, a), (1, b)], "doc_id long, text string")
    got = sorted((x.n_words, x.n_removed) for x in recompress.remove_repeats(df).collect())
    assert got == [(30, 0), (30, 0), (35, 30)]  # rows repeated whole stay; in b the words start later


def test_symbols_inside_equal_passages_are_equal():
    r = np.random.default_rng(0)
    passage = r.integers(0, 2**63, 200).astype(np.uint64)
    one, two = (np.concatenate((r.integers(0, 2**63, n).astype(np.uint64), passage, r.integers(0, 2**63, 9).astype(np.uint64))) for n in (13, 40))
    found = []
    for values, at in ((one, 13), (two, 40)):
        s = recompress.Symbols(values, np.zeros(len(values), int))
        s.name_runs()
        for level in range(4):
            s.name_pairs(level)
        inside = (s.low >= at) & (s.high <= at + 200)
        found.append([(int(n), int(x) - at) for n, x in zip(s.name[inside], s.start[inside], strict=True)])
    assert found[0] == found[1] and 20 < len(found[0]) < 100


@pytest.mark.parametrize("seed,size,many", [(1, 2, 1), (2, 5, repeats.MANY), (3, 40, repeats.MANY), (3, 40, 2), (4, 8, 4)])
def test_bytes(spark, seed, size, many):
    docs = [(d, "".join(w)) for d, w in _repeating_docs(seed, ["a", "é", "b ", "c\n", "0", *[f"x{i} " for i in range(size)]][: size + 3], n=50)]
    docs += [(900, None), (901, ""), (902, "z" * 40_000), (None, docs[0][1]), (903, "\x00" * 120 + "ab" * 90)]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_bytes int")
    got = {x.doc_id: x for x in suffix.remove_repeats(df, many=many).collect()}
    for (d, t), marks in zip(docs, plain_removed([(d, (t or "").encode()) for d, t in docs], 100), strict=True):
        text = (t or "").encode()
        kept = bytes(c for c, m in zip(text, marks, strict=True) if not m)
        spans = len(re.findall("1+", "".join("1" if m else "0" for m in marks)))
        x = got[d]
        assert (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256, bytes(x.kept)) == (len(text), sum(marks), spans, hashlib.sha256(kept).hexdigest(), kept), d
    assert suffix.remove_repeats(df.limit(0)).count() == 0


def test_a_common_phrase_in_other_surroundings(spark):
    """A phrase shorter than a window in every document: its windows are dealt by their own content, and shards stay small."""
    r = random.Random(5)
    phrase = b"all rights reserved by the owners of this site and its affiliates".decode()
    long = "".join(r.choice("abcdef ") for _ in range(130))
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(40))
    docs = [(d, f"{word()} {phrase} {word()}{long if d % 7 == 0 else ''}") for d in range(80)]
    got = {x.doc_id: x for x in suffix.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), many=8).collect()}
    for (d, t), marks in zip(docs, plain_removed([(d, t.encode()) for d, t in docs], 100), strict=True):
        assert (got[d].n_bytes, got[d].n_removed) == (len(t.encode()), sum(marks))
    assert sum(x.n_removed > 0 for x in got.values()) == 11


def test_windows_of_a_common_phrase_are_not_sent(spark):
    """Where only the anchor is common no window goes to a shard, however many documents have it; a repeat beside it is found."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(120))
    docs = [(d, f"{word()} all rights reserved by the owners, 2020 {word()}") for d in range(60)]
    docs += [(60, "x" + docs[3][1][40:190]), (61, "y" + docs[3][1][30:170])]
    own = repeats.keyed(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    for many in (8, repeats.MANY):
        known, variants = suffix.compared_twice(own, repeats.packed(own), many=many)
        assert {x.doc for x in variants.collect()} <= {3, 60, 61}
    got = {x.doc_id: x.n_removed for x in suffix.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), many=8).collect()}
    assert {d: n for d, n in got.items() if n} == {60: 150, 61: 140}


def test_windows_are_held_against_their_bytes():
    text = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4], np.uint16)
    assert suffix._same_bytes(text, np.array([0, 3, 6, 1]), np.array([0, 0, 0, 1]), 3).tolist() == [True, True, False, True]
    assert len(suffix._same_bytes(text, np.zeros(0, int), np.zeros(0, int), 3)) == 0


@pytest.mark.parametrize("memory", [1 << 26, 200], ids=["memory", "disk"])
def test_suffix_arrays(monkeypatch, memory):
    monkeypatch.setattr(suffix.Queues.__init__, "__defaults__", (memory,))
    r = np.random.default_rng(0)
    for k in range(150):
        n, symbols, depth = int(r.integers(1, 60)), int(r.integers(1, 5)), int(r.choice([5, 20, 100]))
        t = np.tile(r.integers(0, symbols, n).astype(np.uint16), 1 + 2 * (k % 3 == 0))
        order, shared = suffix.suffix_array(t, symbols + 1, depth)
        cut = [tuple(t[i : i + depth].tolist()) for i in range(len(t))]
        assert sorted(order.tolist()) == list(range(len(t)))
        for i in range(1, len(t)):
            a, b = cut[order[i - 1]], cut[order[i]]
            same = next((j for j, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert a <= b and min(int(shared[i]), depth) == same


def test_blocks_do_not_matter(spark, monkeypatch):
    docs = [(d, " ".join(w)) for d, w in _repeating_docs(9, [f"w{i}" for i in range(20)], n=40)]
    tables = []
    for block in (50, 1 << 18):
        monkeypatch.setattr(repeats, "BLOCK", block)  # workers keep their own; this changes the local cut below
        flat = [recompress.word_values(t.encode()) for _, t in docs]
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in flat])))
        start, count, key, phash = recompress.cut(np.concatenate(flat), bounds)
        assert count.sum() == sum(max(0, len(x) - 19) for x in flat)
        tables.append(sorted(zip(start.tolist(), count.tolist(), key.tolist(), phash.tolist(), strict=True)))
    assert tables[0] == tables[1]


# --- archives ---


@pytest.mark.parametrize("limit", [10**9, 0], ids=["broadcast", "shuffle"])
def test_archives_round_trip(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", limit)
    r = random.Random(8)
    pages = [(i, f"http://h/{i}", "".join(r.choice("abc é\r\n") for _ in range(r.randint(0, 3000)))) for i in range(120)]
    pages += [(500 + i, "http://same/\r\nx: y", "same payload") for i in range(40)] + [(700, None, None), (701, "u", ""), (702, "big", "x" * 3_000_000), (None, "n", "same payload"), (None, "n", "alone"), (3, *pages[3][1:])]
    df = spark.createDataFrame([(i, u, h, 1) for i, u, h in pages], "page_id long, url string, html string, digest int")
    index = warc.write_archives(df, f"file://{tmp_path}/warc")
    back = warc.read_archives(index).collect()
    kept = {}
    for i, _, h in pages:
        if i is not None:
            kept[h or ""] = max(kept.get(h or "", i), i)
    import base64

    want = []
    for i, _, h in pages:
        raw, best = (h or "").encode(), kept.get(h or "")
        full = best is None or i == best
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if full else "revisit", None if full else best))
    assert sorted(((x.record_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in back), key=repr) == sorted(want, key=repr)
    payloads = {x.record_id: bytes(x.payload) for x in back if x.record_type == "response"}
    assert payloads[702] == b"x" * 3_000_000 and all(payloads[i] == (h or "").encode() for i, _, h in pages[:120])
    record = warc.find_record(index, 57)
    assert record.startswith(b"WARC/1.1\r\n") and pages[57][2].encode() in record and warc.find_record(index, 9999) is None
    assert warc.write_archives(df.limit(0), f"file://{tmp_path}/none").count() == 0


def test_bundles_are_plain_zstandard(spark, tmp_path):
    import zstandard

    df = spark.createDataFrame([(i, "u", f"page {i} " * 2000) for i in range(200)], "page_id long, url string, html string").coalesce(1)
    index = warc.write_archives(df, f"file://{tmp_path}/w")
    path = index.first().bundle.removeprefix("file://")
    with open(path, "rb") as f:  # any reader of the format takes the frames one after the other and skips the table
        text = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert len(list(warc.decode_records(text))) == 200 and index.agg(F.max("frame")).first()[0] > 1


# --- search ---


def plain_top(rows, k):
    ok = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 10 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(8192, 1024), (37, 3)], ids=["one", "many"])
def test_top_k(spark, blocks):
    r = np.random.default_rng(1)
    centres = r.normal(size=(5, 24))
    rows = [(i, (centres[i % 5] + 0.3 * r.normal(size=24)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, [0.5] * 24) for i in range(30)]  # ties
    rows += [(2000, None), (None, [1.0] * 24), (2010, [1.0, None] * 12), (2020, [float("nan")] * 24), (2030, [float("inf")] + [0.0] * 23), (2040, [1.0] * 7), (2041, [2.0] * 7), (2050, []), (2060, [1e30] * 3)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = topk.top_k(df, df.where("vec_id % 10 = 0"), 10, rows_per_block=blocks[0], queries_per_block=blocks[1]).collect()
    want = [x for x in plain_top(rows, 10)]
    assert sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in got) == want
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_bounds_hold():
    r = np.random.default_rng(2)
    a, b = r.normal(size=(40, 21)), r.normal(size=(50, 21))
    exact, last = a @ b.T, None
    for s in topk.SEGMENTS:
        bound = topk.statistics(a, s) @ topk.statistics(b, s).T
        assert (bound >= exact - 1e-9).all()
        assert last is None or bound.mean() <= last.mean()  # finer is tighter
        last = bound


# --- packing ---

VOCAB = "/opt/tokenizers/word_bpe_49k.json"


@pytest.mark.skipif(not os.path.exists(VOCAB), reason="no vocabulary file")
@pytest.mark.parametrize("parts", [1, 5])
def test_packing(spark, monkeypatch, parts):
    monkeypatch.setattr(packing, "MERGE_FAN_IN", 2)
    from tokenizers import Tokenizer

    r = random.Random(4)
    words = ["the", "Straße", "don't", "x's", "ñandú", "42", "a1b2", "!!", "'s", "''s", "“q”", "日本", "<|endoftext|>", " ", "Ⅷ", "é", "ΣΑΣ", "½"]
    docs = [(i, r.choice([" ", "", "\n"]).join(r.choice(words) for _ in range(r.choice([0, 1, 30, 400, 3000])))) for i in range(150)] + [(900, None), (901, ""), (3, "again"), (None, "no id")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, length int").repartition(parts)
    rows = packing.pack(df, VOCAB, open_windows=8).collect()
    model, left = Tokenizer.from_file(VOCAB), {}
    for i, t in docs:
        left.setdefault(i, []).append(np.array(model.encode(t or "", add_special_tokens=False).ids + [1], "<u4"))
    for i, texts in left.items():
        own = [x for x in rows if x.doc_id == i]
        for ids in texts:
            at = 0
            while at < len(ids):
                x = next(x for x in own if x.start == at and x.doc_tokens == len(ids) and x.ids_crc32 == zlib.crc32(ids[at : at + x.length].tobytes()))
                own.remove(x)
                at += x.length
            assert at == len(ids)
        assert not own
    sequences = {}
    for x in rows:
        sequences.setdefault(x.sequence_id, []).append(x)
    for pieces in sequences.values():
        at = 0
        for x in sorted(pieces, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= 2048
    total = sum(len(ids) for texts in left.values() for ids in texts)
    assert len(sequences) * 2048 < 1.1 * total + 2048
    assert packing.pack(df.limit(0), VOCAB).count() == 0
