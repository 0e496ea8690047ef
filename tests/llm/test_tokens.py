"""Remembered words against the tokenizers library, and placing against plain best fit."""

import random

import numpy as np
import public_tokenizers
import pytest

from onomast.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


def ids_of(tokens, texts):
    return [np.array(e.ids, "<u4").tobytes() for e in tokens.model.encode_batch(texts, add_special_tokens=False)]


def test_every_character_as_the_library():
    tokens = packing.WordTokenizer(WORDS)
    inside = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and tokens.plain.fullmatch(chr(c).lower())]  # the others go to the library whole
    texts = [f(chr(c)) for c in [*inside, 0x130, 0x181, 0x300, 0x3A3, 0x1F600] for f in (lambda x: x, lambda x: f"a{x}b", lambda x: f"!{x}", lambda x: f"it's {x}{x} 12{x}'ll")]
    assert len(inside) > 500 and tokens.encode(texts) == ids_of(tokens, texts)


def test_mixed_texts_as_the_library():
    tokens, r = packing.WordTokenizer(WORDS), random.Random(8)
    parts = ["Ɓ", "Ə", "İ", "ß", "ẞ", "K", "Å", "é", "ﬁ", "Σας", "word", "Word's", "12", "½", "<|endoftext|>", "<|", "!", "...", " ", "\n", " ", " ", "漢字", "🙂", "ﷺ", "'S", "\x00", "\x1c", "\x85"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(5000)]
    assert tokens.encode(texts) == ids_of(tokens, texts)


def test_files_of_another_kind():
    tokens = packing.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["Hello, World's 12 things", "", "  two  spaces"]
    assert tokens.words is None and tokens.encode(texts) == ids_of(tokens, texts)


def plain_best_fit(lengths, capacity, most):
    """Windows as lists of piece numbers, in the order in which they are closed; then those left open."""
    open_windows, closed = [], []
    for i, n in enumerate(lengths):
        fits = [w for w in open_windows if capacity - w["used"] >= n]
        if fits:
            w = min(fits, key=lambda w: (capacity - w["used"], w["made"]))
        else:
            if len(open_windows) >= most:
                w = min(open_windows, key=lambda w: (capacity - w["used"], w["made"]))
                open_windows.remove(w)
                closed.append(w["pieces"])
            w = {"used": 0, "made": i, "pieces": []}
            open_windows.append(w)
        w["pieces"].append(i)
        w["used"] += n
        if w["used"] == capacity:
            open_windows.remove(w)
            closed.append(w["pieces"])
    return closed, sorted(w["pieces"] for w in open_windows)


@pytest.mark.parametrize("most", [1, 3, 8])
def test_placing_is_best_fit_and_the_fullest_goes(most):
    r = random.Random(most)
    lengths = [r.randint(1, 99) if r.random() < 0.9 else 50 for _ in range(500)]
    packer = packing._Packer(100, most, 0)
    for i, n in enumerate(lengths):
        packer.add((i, 0, n, 0, n))
    sequences = {}
    for row in packer.out:
        sequences.setdefault(row[5], []).append(row[0])
    closed, left = plain_best_fit(lengths, 100, most)
    assert [sequences[k] for k in sorted(sequences)] == closed
    assert sorted([p[0] for p in packer.windows.held[k]] for _, k in packer.windows.rooms) == left


def test_merging_is_bounded_and_whole(spark, monkeypatch):
    monkeypatch.setattr(packing, "MERGE_FAN_IN", 2)
    docs = spark.range(400).selectExpr("id as doc_id", "repeat('word ', 30 + cast(id % 7 as int)) as text").repartition(16)
    rows = packing.pack(docs, WORDS, capacity=64, open_windows=2).collect()
    per = {}
    for x in rows:
        per.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for pieces in per.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 64
    whole = {}
    for x in rows:
        whole.setdefault(x.doc_id, []).append((x.start, x.length, x.doc_tokens))
    assert len(whole) == 400 and all(sum(n for _, n, _ in v) == v[0][2] for v in whole.values())
