import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from surveyloom.llm import packing
from surveyloom.llm.packing import PackRule, choose, combinations, pack, token_ids


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(pieces, texts, tokenizer, window):
    of, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        of[p.doc_id].append(p)
        sequences[p.sequence_id].append((p.offset, p.length))
    assert set(of) == set(texts)
    for doc, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for p in sorted(of[doc], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : at].tobytes())
        assert at == len(ids)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0 and at < window
    assert sorted(sequences) == list(range(len(sequences)))


def test_every_id_once_in_full_sequences(docs, rows, tokenizer):
    check(pack(docs).collect(), {r[0]: r[1] for r in rows}, tokenizer, 1024)


def test_a_small_window(docs, rows, tokenizer):
    check(pack(docs, PackRule(window=64)).collect(), {r[0]: r[1] for r in rows}, tokenizer, 64)


def test_added_tokens(spark, tokenizer):
    mark = "<|endoftext|>"
    texts = [
        f"hello {mark} world", mark, mark * 3, f"{mark}a", f"a{mark}", f" {mark} ", f"a  {mark}  b\n\n{mark}\n", "<|endoftext|", f"<{mark}>",
        "<|ENDOFTEXT|>", f"it's{mark}'s 12{mark}34", "é" + mark + "日本",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(pack(frame).collect(), dict(enumerate(texts)), tokenizer, 1024)
    ids = tokenizer.encode(texts[0], add_special_tokens=False).ids
    assert token_ids(texts[0], PackRule()).tolist() == [*ids, 0] and 50256 in ids


def test_a_very_long_text_and_clashing_columns(spark, tokenizer):
    text = "word and " * 60_000
    frame = spark.createDataFrame([(1, text, 5, "x"), (2, "a", 6, None)], "doc_id long, text string, part int, tail string")
    check(pack(frame).collect(), {1: text, 2: "a"}, tokenizer, 1024)


def test_odd_rows(odd, empty):
    got = pack(odd).collect()
    assert sum(p.length for p in got if p.doc_id == 1) == 2 * next(p.doc_tokens for p in got if p.doc_id == 1)
    assert sum(p.doc_id == 7 and p.length == 1 for p in got) == 1
    assert any(p.doc_id is None for p in got)
    assert pack(empty).collect() == []


def test_combinations_fill_the_window():
    found = combinations(16, np.array([1, 2, 5, 8, 11, 14, 15]))
    assert (found.sum(axis=1) == 16).all()
    assert [0, 0, 1, 15] in found.tolist() and [0, 0, 8, 8] in found.tolist() and [0, 1, 1, 14] in found.tolist()


def test_counts_never_take_more_than_there_is_and_leave_little():
    rng = np.random.default_rng(4)
    histogram = np.zeros(1025, dtype=np.int64)
    histogram[1:1024] = rng.poisson(40, 1023)
    combos, counts = choose(histogram, 1024)
    used = np.bincount(combos.ravel(), np.repeat(counts, combos.shape[1]), minlength=1025).astype(int)
    used[0] = 0
    assert (used <= histogram).all()
    assert used.sum() > 0.9 * histogram.sum()


def test_choosing_is_as_one_by_one():
    """The same choice as trying all combinations singly, without an object for each of them."""
    rng = np.random.default_rng(5)
    histogram = np.bincount(rng.integers(1, 64, 900), minlength=65)
    combos = packing.combinations(64, np.flatnonzero(histogram[:64]))
    fitted = packing.repeat_counts(combos, histogram)
    left, taken, whole = histogram.copy(), np.zeros(len(combos), int), np.floor(fitted).astype(int)
    left[0] = 0
    for order, most in (
        (np.argsort(-whole, kind="stable"), whole),
        (np.argsort(whole - fitted, kind="stable"), np.ones_like(whole)),
        (np.argsort(-fitted, kind="stable"), np.full_like(whole, 1 << 60)),
    ):
        for i in order:
            length, times = np.unique(combos[i][combos[i] > 0], return_counts=True)
            n = min(int(most[i]), int((left[length] // times).min()))
            left[length] -= n * times
            taken[i] += n
    tracemalloc.start()
    got, counts = packing.choose(histogram, 64)
    assert got.tolist() == combos[taken > 0].tolist() and counts.tolist() == taken[taken > 0].tolist()
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    packing.choose(np.full(513, 40), 512)
    peak = (tracemalloc.get_traced_memory()[1] - before) / len(packing.combinations(512, np.arange(1, 512)))
    tracemalloc.stop()
    # bytes for each combination: four lengths and a few arrays as large
    assert peak < 350
