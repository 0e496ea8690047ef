"""What a Python worker holds: blocks of pairs are small, and one operator's leftovers go when the next uses the worker."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from onomast.llm import packing, similar, simhash
from onomast.llm.common import lean, settle

PATH = public_tokenizers.path("word_bpe_49k.json")


def _peak_mb(work):
    tracemalloc.start()
    try:
        for _ in work:
            pass
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_pairs_are_looked_at_in_small_blocks():
    n, r = 1500, np.random.default_rng(3)
    cols = [np.zeros(n, np.int64), np.full(n, 100), np.arange(n), np.arange(n), np.zeros(n, np.int32)]
    coarse = pa.array(list(r.integers(0, 1 << 62, (n, similar.COARSE))), pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([*map(pa.array, cols), coarse], ["key", "n", "node", "label", "at", "coarse"])
    assert _peak_mb(similar._candidates(iter([batch]))) < 30
    fp = np.sort(r.integers(0, 1 << 62, 4000).astype(np.uint64))
    assert _peak_mb(similar._nearest(np.full(len(fp), 100), fp) for _ in range(1)) < 15
    key, home = np.repeat(np.arange(1000), 40), np.tile(np.arange(40) < 16, 1000)
    assert _peak_mb(simhash._bucket_links(key, home, r.integers(0, 1 << 62, len(key)).astype(np.uint64), np.arange(len(key)), 4)) < 25


def test_nearest_is_the_same_in_any_blocks(monkeypatch):
    r = np.random.default_rng(4)
    fp, n = np.sort(r.integers(0, 1 << 62, 5000).astype(np.uint64)), r.integers(90, 130, 5000)
    small = similar._nearest(n, fp)
    monkeypatch.setattr(similar, "_ROWS_AT_ONCE", similar._NEAR // 2)
    assert all((x == y).all() for x, y in zip(small, similar._nearest(n, fp), strict=True))


def test_an_operator_lets_go_what_another_kept():
    packing.tokenizer_at(PATH)
    settle("packing")
    assert packing.tokenizer_at.cache_info().currsize == 1
    assert list(lean(lambda batches: batches)(iter([1, 2]))) == [1, 2]
    assert packing.tokenizer_at.cache_info().currsize == 0
