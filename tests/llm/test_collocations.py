import random
import re
from collections import Counter

import numpy as np
import pytest

from surveyloom.llm import collocations as co
from surveyloom.llm.collocations import Counts, PhraseRule, collocations, union

SCHEMA = "doc_id long, text string, lang string, phrase string, score string, part int, size int"
U64 = np.uint64


def brute(rows, rule):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, rule.longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= rule.least}
    gone = set()
    for (lang, words), a in cand.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if 100 * a >= rule.percent * f[lang, words[i : i + k]]:
                    gone.add((lang, words[i : i + k]))
    out = {}
    for (lang, words), a in cand.items():
        if (lang, words) not in gone:
            cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
            score, _, le, r = min((1000 * a * n[lang] // (le * r), i, le, r) for i, (le, r) in enumerate(cuts))
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), le, r))
    return sorted(
        (lang, i + 1, p.decode(), -a, le, r, n[lang], -s)
        for lang, own in out.items()
        for i, (s, a, p, le, r) in enumerate(sorted(own)[: rule.top])
    )


def texts(n=400, seed=9):
    rng = random.Random(seed)
    words = ["a", "b", "The", "the", "of", "é", "zz", "long" * 5, "x-y", "日本"] + [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(len(words))]
    out = []
    for _ in range(n):
        own = rng.choices(words, weights, k=rng.choice([0, 1, 3, 30, 120]))
        if rng.random() < 0.4:
            at = rng.randrange(len(own) + 1)
            own[at:at] = "once upon a time there was a fox".split()
        if rng.random() < 0.1:
            own = ["again"] * 20 + own
        text = "".join(w + rng.choice([" "] * 9 + [", ", ".\n", "\t", "  ", "? ", "\x0b", "\x0c "]) for w in own)
        out.append((text, rng.choice(["en", "en", "de", None, "und", ""])))
    return out + [(None, "en"), ("", None), (" \t.;", "fr"), ("once upon a time there was a fox " * 2000, "xx")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "p", "s", 1, 2) for i, (t, g) in enumerate(rows)], SCHEMA)


def got(out):
    return sorted(map(tuple, out.collect()))


RULES = [
    PhraseRule(least=12),
    PhraseRule(least=2, top=7),
    PhraseRule(least=6, percent=60, longest=4),
    PhraseRule(least=3, longest=2),
    PhraseRule(least=5, longest=7),
]


@pytest.mark.parametrize("rule", RULES)
def test_against_all_phrases(spark, rule):
    rows = texts()
    want = brute(rows, rule)
    assert got(collocations(frame(spark, rows).repartition(4), rule)) == want and len(want) > 5


def test_small_stretches(spark, monkeypatch):
    """Very many small transducers come to the same sums."""
    monkeypatch.setattr(co, "STRETCH", 50)
    rows = texts(120)
    rule = PhraseRule(least=8)
    assert got(collocations(frame(spark, rows).repartition(3), rule)) == brute(rows, rule)


def test_words_of_one_hash_are_told_apart(spark, monkeypatch):
    """The first seed gives half of all words the hash of another: the second is taken."""
    plain = co._words

    def worse(batch, seed):
        for words, labels, begins in plain(batch, seed):
            yield words, labels & U64(3) if seed == 0 else labels, begins

    monkeypatch.setattr(co, "_words", worse)
    rows = texts(100)
    rule = PhraseRule(least=8)
    assert got(collocations(frame(spark, rows), rule)) == brute(rows, rule)


def test_odd_tables(spark):
    assert collocations(frame(spark, [("a b", "en")]).limit(0)).collect() == []
    assert collocations(frame(spark, [(None, None), ("", "en"), ("one two three", "en")])).collect() == []
    rows = [("Tie One. tie two. two tie. one tie", "en")] * 120 + [("big " * 300_000, "de")]
    assert got(collocations(frame(spark, rows))) == brute(rows, PhraseRule())


def phrases(rng, n, size):
    return np.unique(rng.integers(0, 12, (n, size)).astype(U64) << U64(60), axis=0)


def test_automata():
    rng = np.random.default_rng(3)
    for size in (1, 2, 3, 5):
        parts = []
        total = Counter()
        for n in (1, 60, 300):
            rows = phrases(rng, n, size)
            weights = rng.integers(1, 4, len(rows))
            machine = Counts.unpack(Counts.of(rows, weights).pack())
            back, counts = machine.phrases(size)
            assert (back == rows).all() and counts.tolist() == weights.tolist()
            parts.append(machine)
            total.update(dict(zip(map(tuple, rows.tolist()), weights.tolist(), strict=True)))
        rows, weights = union(parts, size, 3)
        assert dict(zip(map(tuple, rows.tolist()), weights.tolist(), strict=True)) == {k: v for k, v in total.items() if v >= 3}
        both = Counts.of(*union(parts, size))
        asked = phrases(rng, 200, size)
        answer = both.compose(Counts.of(asked, np.ones(len(asked), np.int64)), size)
        assert answer.tolist() == [total[tuple(x)] for x in asked.tolist()]


def test_equal_ends_are_one_state():
    rows = np.array([[a, 7, 8, 9] for a in range(1, 101)], U64)
    machine = Counts.of(rows, np.full(100, 2))
    assert len(machine.label) == 103
    # other weights are another state
    assert len(Counts.of(rows, np.arange(100) % 2 + 1).label) == 106
