"""The tokenization automaton against the library, and round trips."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from onomast.llm import bpe, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a", "e", "t", "h", " ", "n", "u", "U", "z", "0", "1", "-", "=", "é", "ß", "你", "🙂", "\n", "\t", "'", "s", "ll", "<|endoftext|>", "    ", "aaaa", "....", "the", "ing", "\x00", "\x1c", "\u0085", "Ⅳ", "²", "́", "﻿", "İ", "՘", " ", "\U0001e6ed"]


def texts():
    rng = random.Random(3)
    out = ["", " ", "\n\n", "don't we'll"] + [c * k for c in "aeo-=. \n0A~" for k in range(1, 60)]
    out += ["".join(rng.choice(ODD) for _ in range(rng.randrange(60))) for _ in range(3000)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 0xD7FF), rng.randrange(0xE000, 0x110000)])) for _ in range(20)) for _ in range(500)]
    return out + ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3000))]


def plain_bpe(word, merges):
    """Merge the leftmost pair of least rank until none is left."""
    ranks, parts = {m: i for i, m in enumerate(merges)}, [bytes([b]) for b in word]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: (ranks.get((parts[i], parts[i + 1]), len(ranks)), i))
        if (parts[best], parts[best + 1]) not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts


def test_automaton_of_few_merges():
    """Small alphabets make every kind of overlap, pairs of one token among them."""
    rng = random.Random(11)
    for _ in range(150):
        tokens, merges = [b"a", b"b", b"c"], []
        while len(merges) < 12:
            m = (rng.choice(tokens), rng.choice(tokens))
            if m[0] + m[1] not in tokens:
                merges.append(m)
                tokens.append(m[0] + m[1])
        automaton = bpe.Automaton(merges)
        assert len(automaton.parent) <= len(merges) + 1
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 20)))
            assert [automaton.labels[t] for t in automaton.encode(word)] == plain_bpe(word, merges), (merges, word)


def test_arcs_accept_encodings_only():
    merges = [(b"a", b"b"), (b"ab", b"c"), (b"b", b"c"), (b"a", b"a")]
    automaton = bpe.Automaton(merges)
    for x in automaton.labels[97:100] + automaton.labels[256:]:
        for y in automaton.labels[97:100] + automaton.labels[256:]:
            number = automaton.labels.index
            assert automaton.has_arc(automaton.target[number(x)], number(y)) == (plain_bpe(x + y, merges) == [x, y]), (x, y)


def test_ids_equal_the_library():
    from tokenizers import Tokenizer

    with open(PATH, encoding="utf-8") as f:
        own = bpe.ByteTokenizer(f.read())
    library = Tokenizer.from_file(PATH)
    most = own.most
    for small in (most, 50):  # few words are remembered the second time
        own.most, own.known, own.older = small, {}, {}
        for t in texts():
            ids = np.frombuffer(own.encode(t), "<i4").tolist()
            assert ids == library.encode(t, add_special_tokens=False).ids, repr(t)
            assert own.decode(pa.array([ids], pa.list_(pa.int32())))[0].as_py() == library.decode(ids, skip_special_tokens=False), repr(t)
    lists = [[159, 120], None, [], [159], [1] * 3, [50256, 220], [50257, 10**6, -1]]
    assert own.decode(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == [None if x is None else library.decode([i for i in x if 0 <= i < 50257], skip_special_tokens=False) for x in lists]


def test_other_kinds_of_files_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError, match="byte-level"):
        bpe.ByteTokenizer(f.read())
    with pytest.raises(ValueError, match="two merges"):
        bpe.Automaton([(b"a", b"b"), (b"b", b"c"), (b"ab", b"c"), (b"a", b"bc")])


def test_query(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    rows = [(None, "no id"), (1, None), (2, ""), (3, "same"), (3, "same")] + list(enumerate(texts()[:400], 10))
    spark.createDataFrame([(*r, [1], "x") for r in rows], "doc_id bigint, text string, ids array<int>, decoded string").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    wanted = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        wanted.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, queries.op13_bpe(spark, str(tmp_path)).collect()), key=repr) == sorted(wanted, key=repr)


def test_operators(spark):
    docs = spark.createDataFrame([(1, "Hello  world"), (2, None)], "doc_id bigint, text string")
    ids = bpe.encoded(docs, PATH)
    back = {r.doc_id: (len(r.ids), r.decoded) for r in bpe.decoded(ids.selectExpr("*", "'k' AS kept"), PATH).collect()}
    assert back[1][1] == "Hello  world" and back[2] == (0, "")
    nothing = bpe.decoded(spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>"), PATH).first()
    assert nothing.decoded is None
    assert bpe.decoded(bpe.encoded(docs.where("false"), PATH), PATH).count() == 0
