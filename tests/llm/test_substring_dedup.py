import hashlib

import numpy as np
import pyarrow as pa
import pytest
from corpus import frame, words_of

from surveyloom.llm import substring_dedup
from surveyloom.llm.substring_dedup import COVERS, RepeatRule, remove_repeats


@pytest.mark.parametrize("period", sorted(COVERS))
def test_any_two_places_have_a_common_shift_onto_the_cover(period):
    cover = set(COVERS[period])
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


def brute(rows, length):
    own = {r[0]: words_of(r[1]) for r in rows}
    first = {}
    for d in sorted(own):
        for s in range(len(own[d]) - length + 1):
            first.setdefault(tuple(own[d][s : s + length]), (d, s))
    out = {}
    for d, words in own.items():
        gone = [False] * len(words)
        for s in range(len(words) - length + 1):
            if first[tuple(words[s : s + length])] < (d, s):
                gone[s : s + length] = [True] * length
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[d] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept if any(gone) else None)
    return out


def check(df, rows, rule):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in remove_repeats(df, rule).collect()}
    want = brute(rows, rule.length)
    assert got == want
    return sum(w[1] for w in want.values())


@pytest.mark.parametrize("rule", [RepeatRule(), RepeatRule(length=8, period=3), RepeatRule(length=13, period=7)])
def test_like_all_windows(docs, rows, rule):
    assert check(docs, rows, rule) > 500


def test_packs_of_a_few_hashes_give_the_same(docs, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PACK", 50)
    check(docs, rows, RepeatRule())


def test_odd_rows(odd, empty):
    got = [(r.doc_id, r.n_words, r.n_removed) for r in remove_repeats(odd).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 60, 0), (1, 60, 0), (2, 60, 58), (2, 61, 60), (None, 60, 60), (None, 0, 0), (7, 0, 0)], key=str
    )
    assert remove_repeats(empty).collect() == []


def test_windows_are_told_apart_by_the_second_half(docs, rows, monkeypatch):
    real = substring_dedup.windows

    def coarse(values, size, *base):
        found = real(values, size, *base)
        # the first half is the same for many windows
        return found if base else found & np.uint64(7)

    monkeypatch.setattr(substring_dedup, "windows", coarse)
    hashes = np.array([3, 3, 3, 3], np.uint64)
    check = np.array([8, 9, 8, 9], np.uint64)
    doc, start = np.array([1, 1, 2, 2]), np.array([0, 4, 0, 9], np.int32)
    assert sorted(substring_dedup._later(hashes, check, doc, start)) == [2, 3]
    words = pa.array([" ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))])
    starts = pa.array([[np.arange(60, dtype=np.int32).tobytes()]] * 2)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([1, 2]), words, starts], ["doc", "text_key", "text", "starts"])
    sent = list(substring_dedup._extend(RepeatRule(), 4)(iter([batch])))
    assert all(part >= 0 for b in sent for part in b.column(0).to_pylist())
